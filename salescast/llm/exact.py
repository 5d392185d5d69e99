"""Exact dedup by content-defined chunk recipes, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescast.llm.common import keep_rows, one_row, repeats, text_of
from salescast.staging import materialize

#: A chunk ends after the first line or sentence end that follows its first 1,024 characters, and after
#: 8,192 characters where there is none. Both depend on the text alone, so equal texts are cut alike.
CHUNK = r"(?s).{1023,8191}?[\n.!?]|.{1,8192}"


def chunks(text: Column) -> Column:
    """The text cut where its content says; the chunks in order make up the whole text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def recipes(docs: DataFrame, fingerprint: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(id, sha, parts): the ordered fingerprints of each row's chunks, each with the chunk's SHA-256.

    The only step that reads a text; everything after it moves these narrow rows.
    """
    text = text_of()
    return docs.select(
        F.col("doc_id").alias("id"), F.sha2(text, 256).alias("sha"),
        F.transform(chunks(text), lambda c: F.struct(
            fingerprint(c).alias("fp"), F.unhex(F.sha2(c, 256)).alias("proof"))).alias("parts"))


def verified(parts: DataFrame) -> DataFrame:
    """(id, sha, ids, proofs): recipes whose identifiers stand for one chunk each.

    Chunks are grouped by fingerprint, and the grouping says whether all chunks behind a fingerprint have
    one SHA-256. Rows with a fingerprint that stands for several chunks carry the digests beside the
    fingerprints; equal texts hold the same chunks, so they are marked alike. Other rows carry none.
    """
    each = parts.select("id", "sha", F.explode("parts").alias("p")).select("id", "sha", "p.*")
    doubtful = (each.groupBy("fp").agg(F.min("proof").alias("least"), F.max("proof").alias("most"))
                .where("least <> most").select("fp"))
    marked = (each.join(doubtful, "fp", "left_semi").select(F.col("sha").alias("m_sha")).distinct()
              .withColumn("marked", F.lit(True)))
    return (parts.join(marked, F.col("sha") == F.col("m_sha"), "left").select(
        "id", "sha", F.col("parts.fp").alias("ids"),
        F.when(F.col("marked"), F.col("parts.proof")).otherwise(F.array().cast("array<binary>")).alias("proofs")))


def exact_groups(docs: DataFrame, fingerprint: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are equal when their verified chunk identifiers are the same in the same order. Of equal texts the
    row with the largest doc_id stays. A null text counts as empty, and all empty texts form a group. A null
    doc_id is smaller than any other. Rows that repeat a doc_id count as documents of their own; where they
    also share the text, one of them stays. An empty table gives no rows; other columns are not read.

    Texts are read once and never shuffled. A group may hold any share of the rows: it is counted with
    partial sums, and the way back to the rows is a join of stored tables that Spark splits where it is skewed.
    """
    parts = materialize(recipes(docs, fingerprint), "exact-recipes")
    keyed = materialize(verified(parts), "exact-verified")
    groups = materialize(
        keyed.groupBy("ids", "proofs").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(F.col("ids").alias("g_ids"), F.col("proofs").alias("g_proofs"), "keep_id", "n"),
        "exact-groups")
    found = keyed.join(groups, (F.col("ids") == F.col("g_ids")) & (F.col("proofs") == F.col("g_proofs")), "left")
    out = found.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"), F.col("sha").alias("text_sha256"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    if repeats(parts, "id"):
        nth = F.row_number().over(Window.partitionBy("doc_id", "text_sha256").orderBy(F.lit(0)))
        stays = stays & (nth == 1)
    return out.withColumn("kept", stays).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_exact(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are.

    The row that stays is the one ``exact_groups`` keeps; of several with its id and text, the one with the least hash. Odd
    rows as in :func:`exact_groups`. Only the ids to drop meet the documents.
    """
    groups = exact_groups(docs)
    if not repeats(docs, "doc_id"):
        return keep_rows(docs, groups.where("not kept"))
    # Other texts under a dropped id must stay, and one of several equal rows under a kept id.
    keys = groups.where("kept").select(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_sha"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").alias("r_id"), F.sha2(text_of(), 256).alias("r_sha"))
    same = F.col("r_id").eqNullSafe(F.col("k_id")) & (F.col("r_sha") == F.col("k_sha"))
    return one_row(rows.join(keys, same, "left_semi"), "r_id", "r_sha")
