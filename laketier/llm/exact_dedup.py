"""Operator 7: exact duplicates by content-defined chunk recipes (DataFrame functions only).

A text, its runs of white space replaced by one blank, is cut into chunks where its
own content says so (punctuation or a blank after a certain ending, between
``MIN_CHUNK`` and ``MAX_CHUNK`` characters), so equal texts have equal chunks. The
chunks are deduplicated once: every distinct chunk is moved a single time, keyed by
its 64-bit fingerprint *and* its text, which verifies that a fingerprint identifies
one chunk. A document is then only its recipe, the ordered list of chunk
identifiers; equal recipes are equal texts. Where two chunks share a fingerprint,
recipes that use it carry those chunks' texts as well, which keeps the comparison
exact (chance makes some 10^-7 such fingerprints in 10^6 chunks). Recipes alone form the
groups; the hash of the whole text is only reported.

Whole texts move once, in pieces and after a partial deduplication in each task; a
group with a third of all rows is reduced in the tasks that read it, and is joined
to its one result row by a join that Spark can split.

Defined cases: NULL counts as empty; empty texts are one group; of rows that share
the smallest id of a group all are kept (they are one document); NULL ids are
larger than any id, and a group with NULL ids alone keeps its rows; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketier.llm.common import BLANKS, staged

MIN_CHUNK, MAX_CHUNK = 256, 2048
#: After a stop or comma, or a blank that ends a word in a consonant pair: every
#: script has stops, and texts without either are cut at MAX_CHUNK.
CHUNK = (rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?:[.,;:!?。、] ?|[bcdfghjklmnpqrstvwxz]{{2}} )"
         rf"|.{{1,{MAX_CHUNK}}}")
#: Fingerprints shared by chunks with different texts are listed in the plan; by the
#: birthday bound 100 TB of text has a few thousand.
MAX_SHARED = 1_000_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def exact_duplicates(docs: DataFrame, fingerprint=F.xxhash64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    ``fingerprint`` maps a chunk to a bigint; tests pass a poor one.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        normalised(F.col("text")).alias("norm"))
    cut = texts.select("doc_id", "norm",
                       F.regexp_extract_all("norm", F.lit(CHUNK), F.lit(0)).alias("chunks"))
    chunks = (cut.select(F.explode("chunks").alias("chunk"))
              .select(fingerprint("chunk").alias("print"), "chunk"))
    shared = [r["print"] for r in
              chunks.groupBy("print", "chunk").agg(F.lit(1).alias("one"))
              .groupBy("print").agg(F.count("*").alias("n"))
              .where("n > 1").limit(MAX_SHARED + 1).collect()]
    if len(shared) > MAX_SHARED:
        raise ValueError("the fingerprint does not tell chunks apart")
    told = (F.filter("chunks", lambda c: fingerprint(c).isin(shared)) if shared
            else F.array().cast("array<string>"))
    recipes = staged(cut.select(
        "doc_id", F.sha2("norm", 256).alias("text_sha256"),
        F.transform("chunks", lambda c: fingerprint(c)).alias("recipe"),
        told.alias("told")), "recipes")
    key = ["recipe", "told"]
    groups = staged(recipes.groupBy(*key).agg(F.min("doc_id").alias("keep_id"),
                                              F.count("*").alias("group_size")), "groups")
    return (recipes.join(groups, key)
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
