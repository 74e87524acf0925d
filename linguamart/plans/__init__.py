"""Table plans: bronze to silver, staging, marts, analyst questions and the daily run."""
