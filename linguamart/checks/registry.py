"""Where the queries and their SQL are collected."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark, sf_dir, name):
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
