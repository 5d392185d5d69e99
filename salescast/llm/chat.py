"""Chat formatting in budgeted windows, with a loss mask that counts every assistant text once."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescast.llm.common import text_of
from salescast.llm.mixing import size_of
from salescast.staging import materialize

#: Tokens of a window and of the turns before it that are repeated; tokens a turn has beside its words.
BUDGET, HISTORY, EXTRA = 1024, 192, 4
#: Turns whose running sums are made together.
BLOCK = 256

# The template, and strings that other templates give a meaning to.
TURN, END = "<|turn|>", "<|end|>\n"
CONTROL = r"(<\||\|>|</?s>|\[/?INST\]|<</?SYS>>)"


def escape(text: Column) -> Column:
    """Text without control strings: a backslash stands after their first character, and before each backslash."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, r"(?=" + CONTROL + r")(.)", r"$2\\")


def escape_role(role: Column) -> Column:
    """A role also keeps its line: a line end in it gets a backslash before it."""
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _ordered(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text, n (tokens), before (tokens of earlier turns) of each turn.

    Turns are ordered by number, null first, then by role and text. Sums run inside blocks of turn numbers and over the
    blocks' totals, so that a conversation of any length is summed in many tasks.
    """
    turns = materialize(rows.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"),
        text_of().alias("text"), (size_of() + EXTRA).alias("n"),
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).alias("block")), "turns")
    totals = turns.groupBy("conv", "block").agg(F.sum("n").alias("total")).select(
        F.col("conv").alias("b_conv"), F.col("block").alias("b_block"),
        (F.sum("total").over(Window.partitionBy("conv").orderBy("block")) - F.col("total")).alias("base"))
    run = Window.partitionBy("conv", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    return (turns.withColumn("until", F.sum("n").over(run)).withColumn("place", F.count(F.lit(1)).over(run))
            .join(totals, F.col("conv").eqNullSafe(F.col("b_conv")) & (F.col("block") == F.col("b_block")))
            .select("conv", "turn", "role", "text", "n", "block", "place", (F.col("base") + F.col("until") - F.col("n")).alias("before")))


def windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, span, formatted, fresh_at, loss, n_tokens, over_budget: one row a training window.

    A turn's window follows from the tokens before it: windows start every ``(budget - history - system) / 2`` tokens
    and hold the turns that begin in their stretch, so a window fits its budget whenever no turn is longer than the stretch;
    ``over_budget`` marks the others. A window repeats the conversation's system turn (its first) and the
    last turns before it, up to ``history`` tokens. ``fresh_at`` is where its own turns begin; ``loss`` lists start and length
    of the assistant texts among them, so repeated ones are masked. Positions count code points.

    A null text or role counts as empty, and a null conv_id is a conversation of its own. Rows that repeat a turn are
    turns one after the other. An empty table gives no rows; other columns are not read.
    """
    system = materialize(
        rows.where("role = 'system'").select(
            F.col("conv_id").alias("s_conv"), F.struct(F.col("turn").cast("long").alias("turn"), text_of().alias("text"),
                                                       (size_of() + EXTRA).alias("n")).alias("own"))
        .groupBy("s_conv").agg(F.min("own").alias("system")), "system-turns")
    stretch = F.greatest(F.floor((budget - history - F.coalesce("system.n", F.lit(0))) / 2), F.lit(64))
    placed = materialize(
        _ordered(rows).join(system, F.col("conv").eqNullSafe(F.col("s_conv")), "left").drop("s_conv")
        .withColumn("stretch", stretch).withColumn("span", F.floor(F.col("before") / F.col("stretch"))), "placed-turns")
    end = F.max(F.col("before") + F.col("n")).over(Window.partitionBy("conv", "span"))
    # The next window begins where this one ends; the last window has none after it.
    late = (placed.withColumn("end", end).withColumn("next", F.floor(F.col("end") / F.col("stretch")))
            .where((F.col("end") - F.col("before") <= history) & (F.col("next") > F.col("span")))
            .withColumn("span", F.col("next")).withColumn("fresh", F.lit(False)).drop("end", "next"))
    each = placed.withColumn("fresh", F.lit(True)).unionByName(late)
    head = F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    piece = F.struct(
        "fresh", "block", "place", "turn", "text", "n", (F.col("role") == "assistant").alias("target"),
        (F.col("role") == "system").alias("is_system"),
        F.length(head).cast("long").alias("lead"), F.length(body).cast("long").alias("size"),
        F.concat(head, body, F.lit(END)).alias("line"))
    grouped = (
        each.groupBy("conv", "span").agg(F.collect_list(piece).alias("pieces"), F.first("system").alias("system"),
                                         F.max("fresh").alias("any"))
        .where("any").withColumn("pieces", F.sort_array("pieces")))
    # The system turn comes first unless the window holds it already.
    there = F.exists("pieces", lambda p: p["is_system"] & p["turn"].eqNullSafe(F.col("system.turn")) & (p["text"] == F.col("system.text")))
    first = F.when(F.col("system").isNotNull() & ~there, F.concat(
        F.lit(f"{TURN}system\n"), escape(F.col("system.text")), F.lit(END))).otherwise(F.lit(""))
    tokens = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["n"])
    line = grouped.withColumn("first", first).withColumn(
        "n_tokens", tokens + F.when(F.col("first") != "", F.col("system.n")).otherwise(F.lit(0)))
    walk = F.aggregate(
        "pieces",
        F.struct(F.length("first").cast("long").alias("at"), F.lit(None).cast("long").alias("fresh_at"),
                 F.array().cast("array<struct<start:bigint,size:bigint>>").alias("loss")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["line"])).alias("at"),
            F.coalesce(a["fresh_at"], F.when(p["fresh"], a["at"])).alias("fresh_at"),
            F.when(p["fresh"] & p["target"], F.concat(a["loss"], F.array(F.struct(
                (a["at"] + p["lead"]).alias("start"), p["size"].alias("size"))))).otherwise(a["loss"]).alias("loss")))
    return line.withColumn("walk", walk).select(
        F.col("conv").alias("conv_id"), "span",
        F.concat("first", F.array_join(F.transform("pieces", lambda p: p["line"]), "")).alias("formatted"),
        F.col("walk.fresh_at").alias("fresh_at"), F.col("walk.loss").alias("loss"), "n_tokens",
        (F.col("n_tokens") > budget).alias("over_budget"))


_LINE = re.compile(r"<\|turn\|>((?:\\.|[^\\\n])*)\n((?:\\.|[^\\<]|<(?!\|end\|>\n))*)<\|end\|>\n", re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted window."""
    out, at = [], 0
    while at < len(formatted):
        got = _LINE.match(formatted, at)
        if not got:
            raise ValueError("not in the format of a window")
        out.append((unescape(got[1]), unescape(got[2])))
        at = got.end()
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From windows sorted by conversation and span, a row for each conversation."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])
    now, done = None, []

    def start(conv):
        return {"conv": conv, "turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "long": 0, "windows": 0}

    def row(x):
        return (x["conv"], x["turns"], x["all"].hexdigest(), x["chars"], x["loss"].hexdigest(), x["long"], x["windows"])

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        for conv, text, fresh_at, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "fresh_at", "loss"))):
            if now is None or conv != now["conv"]:
                if now:
                    done.append(row(now))
                now = start(conv)
            for role, said in read_turns(text[fresh_at:]):
                now["turns"] += 1
                now["all"].update(f"{role}\n{said}\n".encode())
            for part in loss:
                target = unescape(text[part["start"]:part["start"] + part["size"]])
                now["chars"] += len(target)
                now["loss"].update(target.encode())
            now["long"] += len(text)
            now["windows"] += 1
        if done:
            yield batch_of(done)
            done = []
    if now:
        yield batch_of([row(now)])


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from the windows of each conversation.

    A digest runs over the turns in order, so a conversation's windows pass one task; they stream, and only a window is held.
    """
    return (formatted.select(F.col("conv_id").cast("long"), "span", "formatted", "fresh_at", "loss")
            .repartition("conv_id").sortWithinPartitions("conv_id", "span")
            .mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                  "formatted_chars long, n_windows long"))
