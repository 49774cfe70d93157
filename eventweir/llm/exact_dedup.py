"""Exact dedup by a tree-merge of sorted digest runs, with DataFrame functions only.

The partitions of the input are runs 0 .. P - 1: their rows' digests, kept in the shared folder. In round k, runs whose numbers differ
in digit k only (base ``fan_in``) exchange: each row goes to the run that has its digest's digit there, which merges the ``fan_in``
sorted pieces it gets and keeps, of equal digests, the identifier that stays and a count. After the last round a
digest's number is that of its run, so every run holds all there is of its digests, and all runs are about as long. In no
round more than ``fan_in`` rows of a digest meet, however many copies the corpus holds. No task ever gathers a group of copies.

What was decided is sent back to the rows: groups of two and more are broadcast if their counted number allows, else they
travel down the same rounds, where again at most ``fan_in`` rows meet one.

The digest is SHA-256. A second hash (XXH64) and the byte length are part of the key in every round, which verifies that texts are
merged only where all three agree; texts themselves aren't shipped for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import materialise, text_or_empty
from .simhash import ROW, row_keys

KEY = ["_d", "_v", "_n"]


def digest(text: Column) -> list[Column]:
    t = text_or_empty(text)
    return [F.unhex(F.sha2(t, 256)).alias("_d"), F.xxhash64(t).alias("_v"), F.octet_length(t).alias("_n")]


class Runs:
    """The digests of a table as runs, and the rounds of their merge."""

    def __init__(self, docs: DataFrame, id_col: str, text: Column, keep: str, fan_in: int):
        if keep not in ("largest", "smallest"):
            raise ValueError(f"keep: {keep!r}")
        if fan_in < 2 or fan_in & (fan_in - 1):
            raise ValueError(f"fan_in must be a power of two, not {fan_in}")
        self.best, self.bits, self.fan_in = F.max if keep == "largest" else F.min, fan_in.bit_length() - 1, fan_in
        most = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rows = docs.select(docs[id_col].alias("_id"), text_or_empty(text).alias("_t"))
        rows = rows.select("_id", F.monotonically_increasing_id().alias("_uid"), F.pmod(F.spark_partition_id(), F.lit(most)).cast("int").alias("_run"), *digest(F.col("_t")))
        self.rows = materialise(rows, "digest-runs")
        n_runs, self.rounds = (self.rows.agg(F.max("_run")).first()[0] or 0) + 1, 0
        while fan_in**self.rounds < n_runs:
            self.rounds += 1
        self.n_runs = fan_in**self.rounds

    def partner(self, k: int) -> Column:
        """The run that a row of a run belongs to after round k."""
        place, low = self.bits * k, (1 << self.bits) - 1
        own = F.shiftright("_run", place).bitwiseAND(low)
        digit = F.shiftrightunsigned("_v", place).bitwiseAND(low).cast("int")
        return (F.col("_run") + F.shiftleft(digit - own, place)).cast("int")

    def merge(self, rows: DataFrame, win: Column, size: Column) -> DataFrame:
        """Each run sorted by digest; what is equal is one row."""
        runs = rows.repartitionById(self.n_runs, "_run").sortWithinPartitions("_run", *KEY)
        return runs.groupBy("_run", *KEY).agg(self.best(win).alias("_win"), size.alias("_size"))

    def up(self) -> list[DataFrame]:
        levels = [self.merge(self.rows, F.struct("_id", "_uid"), F.count(F.lit(1)))]
        for k in range(self.rounds):
            levels.append(self.merge(levels[-1].withColumn("_run", self.partner(k)), F.col("_win"), F.sum("_size")))
        return levels

    def groups(self) -> tuple[list[DataFrame], DataFrame, int]:
        """(levels, groups of two and more, their number)."""
        levels = self.up()
        groups = materialise(levels[-1].where("_size > 1"), "groups")
        return levels, groups, groups.count()

    def down(self, levels: list[DataFrame], groups: DataFrame) -> DataFrame:
        """The groups for each run of the input that holds one of their rows."""
        found = groups
        for k in reversed(range(self.rounds)):
            above = found.withColumnRenamed("_run", "_up")
            found = levels[k].select("_run", *KEY, self.partner(k).alias("_up")).join(above, ["_up", *KEY]).drop("_up")
        return found

    def with_groups(self, broadcast_rows: int) -> DataFrame:
        levels, groups, n = self.groups()
        if n <= broadcast_rows:
            return self.rows.join(F.broadcast(groups.drop("_run")), KEY, "left")
        return self.rows.join(self.down(levels, groups), ["_run", *KEY], "left")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text: Column | str = "text", keep: str = "largest", fan_in: int = 8, broadcast_rows: int = 1 << 18) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256.

    Of rows with equal text the one with the largest (keep="largest") or smallest identifier stays; of repeated rows with the
    same identifier and text exactly one. A null text counts as empty, a null identifier as smaller than any other. An empty
    table gives an empty result; other columns of docs are not looked at, whatever their names.
    """
    rows = Runs(docs, id_col, docs[text] if isinstance(text, str) else text, keep, fan_in).with_groups(broadcast_rows)
    alone = F.col("_size").isNull()
    return rows.select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("_win._id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("_uid") == F.col("_win._uid"))).alias("kept"),
        F.lower(F.hex("_d")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: str = "largest", fan_in: int = 8, broadcast_rows: int = 1 << 18) -> DataFrame:
    """docs without the copies that exact_dedup drops, all columns as they were.

    Of rows with equal text and identifier that differ elsewhere the one with the smallest hash of its columns stays, of rows equal in
    all columns one. Null texts are empty, so of null and empty texts one row stays; null identifiers are smaller than others; an
    empty table stays empty. Texts are shuffled only if the counted groups are too many to broadcast.
    """
    runs = Runs(docs, id_col, docs[text], keep, fan_in)
    _, groups, n = runs.groups()
    if not n:
        return docs
    small = (lambda df, k: F.broadcast(df) if k <= broadcast_rows else df)
    own = runs.rows.join(small(groups.drop("_run"), n), KEY).where(F.col("_id").eqNullSafe(F.col("_win._id")))
    tied = materialise(own.groupBy(*KEY).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("_d").alias("__ew_tied")), "ties")
    n_tied = tied.count()
    wins = groups.select(*[F.col(k).alias(f"__ew{k}") for k in KEY], F.col("_win._id").alias("__ew_id"), F.lit(True).alias("__ew_copied"))
    d, v, size = digest(docs[text])
    same = (d == wins["__ew_d"]) & (v == wins["__ew_v"]) & (size == wins["__ew_n"])
    left = docs.join(small(wins, n), same, "left").where(F.col("__ew_copied").isNull() | docs[id_col].eqNullSafe(F.col("__ew_id")))
    if not n_tied:
        return left.select(*[docs[c] for c in docs.columns])
    left = left.select(*[docs[c] for c in docs.columns], F.col("__ew_d"))
    alone = left.join(small(tied, n_tied), F.col("__ew_d") == F.col("__ew_tied"), "left_anti").drop("__ew_d")
    ties = row_keys(left.join(small(tied, n_tied), F.col("__ew_d") == F.col("__ew_tied")).drop("__ew_tied"))
    first = materialise(ties.groupBy("__ew_d").agg(F.min(F.struct(*ROW)).alias("s")).select(*[F.col(f"s.{k}") for k in ROW]), "first")
    return alone.unionByName(ties.join(first, list(ROW), "left_semi").dropDuplicates(list(ROW)).drop(*ROW, "__ew_d"))
