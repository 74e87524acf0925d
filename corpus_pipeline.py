"""The documents of a training corpus, from quality to packed sequences: five stages, each a written table for the next."""

from pyspark.sql import functions as F

from linguamart.llm import leaks, neardup, packing, ranking, repeats
from linguamart.llm.common import saved, table
from linguamart.llm.queries import tokenizer_path


def _rows(docs):
    """``docs`` as one struct column, ``row``, beside what tells a row: its id and the hash of its text (null: empty)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"))


def _same(left, right):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def _others(docs):
    """All columns but the text, which the operators hand on by itself, so that it moves once."""
    return [F.col(f"`{c}`") for c in docs.columns if c != "text"]


def quality(spark, docs, sf_dir):
    """Drops the documents that the ranking predicts to be bad. All columns stay as they are; a null text is judged as empty."""
    scored = ranking.score_documents(docs, table(spark, sf_dir, "labels"), keep=_others(docs), with_text=True)
    return scored.where("predicted = 1").select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def near_duplicates(spark, docs, sf_dir):
    """Keeps one document of each group that near-duplicate links (a similarity of 0.8 or more) connect: that of the least id.

    Documents without a word are no one's duplicate, and stay. Of rows with the same id and text one stays, that with the
    least hash of all its columns; of a group without any id, one of each text. No documents give none.
    """
    kept = neardup.near_duplicates(docs, share=80).where("kept").select("doc_id", "text_hash").distinct()
    rows = _rows(docs)
    rows = rows.join(kept, _same(rows, kept), "left_semi")
    return rows.groupBy("doc_id", "text_hash").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def substrings(spark, docs, sf_dir):
    """Removes repeated passages; documents of which no word is left go. n_chars, if there, follows the new text.

    A document that loses nothing keeps its text as it is, a null text too; of others the words left are joined by one space.
    """
    done = repeats.remove_repeats(docs, keep=_others(docs), as_is=True)
    done = done.where("n_removed = 0 or n_removed < n_words")
    cut = F.col("n_removed") > 0
    new = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return done.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


def decontaminate(spark, docs, sf_dir):
    """Drops the documents that hold a benchmark item or a part of it.

    A null or empty text holds none and stays, as do all documents where there is no benchmark; repeated rows go or stay
    together, a row without an id by its text. The columns stay as they are; no documents give none.
    """
    found = saved(leaks.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "text_hash").distinct(), "leaks")
    rows = _rows(docs)
    return rows.join(found, _same(rows, found), "left_anti").select("row.*")


def pack(spark, docs, sf_dir):
    """Packs what is left into sequences of at most 2048 tokens: one row per piece.

    A null text counts as empty and is one token, its end; rows of one id are packed each by itself, those without one
    with a null id. Other columns are not looked at; no documents give no piece.
    """
    return packing.pack_documents(docs, tokenizer_path(), special=True)


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("substrings", substrings), ("decontaminate", decontaminate), ("pack", pack),
]

#: SQL cannot express a learnt ranking; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
