"""Current values kept in spans of time, of which a batch replaces only those it touches.

    rows/span=<span>/batch=<n>     a span as batch n left it
    players/batch=<n>              players that batch n numbered; batch=base-<n> holds all before it
    manifest/<n>.json              which version of each span holds after batch n

A batch writes new versions of its spans and then its manifest, by one rename. A reader sees
the spans of the newest manifest only, so a batch that breaks off shows nothing. A batch that
runs again starts from the manifest before it and replaces what it wrote. The
versions of the last two manifests are kept, all others are deleted.

Distinct players are exact bitmaps: players are numbered without gaps by a dictionary table
and the numbers of a span fill bitmaps of 32,768 bits, so a player costs a span one bit,
however many sessions and batches they come with. One stream writes to a root; another one is refused,
as its numbers of batches mean something else.
"""

import json
from collections.abc import Callable, Iterable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curfew.sources.warehouse import delete_folder, names, put_text, read_text

#: Files of new players that are merged into one base when there are more.
LOOSE_PLAYERS = 16
BUCKETS_TOGETHER = 256


class SpanTable:
    """The spans under ``root``. ``layout`` holds the columns of a row, without its span. ``derived`` names
    further rows of a span, with their layout and how they come from the rows of whole spans; they
    are replaced with them."""

    def __init__(self, spark: SparkSession, root: str, layout: str, writer: str | None = None,
                 derived: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] | None = None):
        self.spark, self.root, self.writer, self.derived = spark, root, writer, derived or {}
        self.layouts = {"rows": layout, **{name: kind for name, (kind, _) in self.derived.items()}}

    def manifest(self, before: int | None = None) -> dict:
        """The newest manifest, or the newest one of a batch earlier than ``before``."""
        numbers = [int(n.removesuffix(".json")) for n in names(self.spark, f"{self.root}/manifest") if n.endswith(".json")]
        known = [n for n in numbers if before is None or n < before]
        if self.writer and numbers:
            owner = self._manifest(max(numbers))["writer"]
            if owner != self.writer:
                raise ValueError(f"{self.root} belongs to another stream, {owner}")
        if not known:
            return {"batch": -1, "spans": {}, "players": [], "numbered": 0, "newest": None, "closed_before": None}
        return self._manifest(max(known))

    def _manifest(self, number: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.root}/manifest/{number:012d}.json"))

    def read(self, manifest: dict | None = None, spans: list[str] | None = None, kind: str = "rows") -> DataFrame:
        """Rows of some spans, or of all, as a manifest has them; no other file is listed."""
        held = (manifest or self.manifest())["spans"]
        paths = [f"{self.root}/{kind}/span={s}/batch={n}" for s, n in held.items() if spans is None or s in spans]
        if not paths:
            return self.spark.createDataFrame([], self.layouts[kind])
        return self.spark.read.schema(self.layouts[kind]).parquet(*paths)

    def _write(self, rows: DataFrame, kind: str, batch: int, span_of: Column) -> None:
        # Few files for a span: one for as many buckets of players as fit in a file.
        placed = rows.withColumns({"span": span_of, "batch": F.lit(batch)})
        together = [F.expr(f"bucket div {BUCKETS_TOGETHER}")] if "bucket" in rows.columns else []
        placed.repartition("span", *together).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("span", "batch").parquet(f"{self.root}/{kind}")

    def replace(self, batch: int, delta: DataFrame, before: dict, fold: Callable[[DataFrame], DataFrame],
                span_of: Column, touched: Iterable[str], reopened: Iterable[str] = (), **noted) -> dict:
        """The ``touched`` spans, folded from what they held and ``delta``, become those of ``batch``. The rows of
        the ``reopened`` ones go into those that ``span_of`` now gives them, which are among the touched."""
        new = sorted(touched)
        held = [s for s in before["spans"] if s in {*new, *reopened}]
        self._write(fold(self.read(before, held).unionByName(delta)), "rows", batch, span_of)
        kept = {s: n for s, n in before["spans"].items() if s not in reopened}
        manifest = {**before, **noted, "writer": self.writer, "batch": batch, "spans": kept | dict.fromkeys(new, batch)}
        for kind, (_, build) in self.derived.items():
            self._write(build(self.read(manifest, new)), kind, batch, span_of)
        self.commit(manifest)
        return manifest

    def commit(self, manifest: dict) -> None:
        put_text(self.spark, f"{self.root}/manifest/{manifest['batch']:012d}.json", json.dumps(manifest))
        self._drop_old(manifest["batch"])

    def _drop_old(self, batch: int) -> None:
        """Delete what neither this manifest nor the one before it names."""
        numbers = sorted(int(n.removesuffix(".json")) for n in names(self.spark, f"{self.root}/manifest") if n.endswith(".json"))
        earlier = [n for n in numbers if n < batch]
        kept = [self._manifest(n) for n in [*earlier[-1:], batch]]
        named = {(s, str(n)) for m in kept for s, n in m["spans"].items()}
        dropped = {m for m in numbers if m < batch and m not in earlier[-1:]}
        # Only spans that changed since the oldest manifest can hold something to delete.
        oldest = [self._manifest(n) for n in sorted(dropped)]
        versions = {(s, n) for m in [*oldest, *kept] for s, n in m["spans"].items()}
        several = [s for s, _ in versions]
        changed = {s for s in set(several) if several.count(s) > 1 or s not in kept[-1]["spans"] or (s, batch) in versions}
        for span in changed:
            for kind in self.layouts:
                folder = f"{self.root}/{kind}/span={span}"
                for name in names(self.spark, folder):
                    if (span, name.removeprefix("batch=")) not in named:
                        delete_folder(self.spark, f"{folder}/{name}")
                if not names(self.spark, folder):
                    delete_folder(self.spark, folder)
        players = {p for m in kept for p in m["players"]}
        for name in names(self.spark, f"{self.root}/players"):
            if name.removeprefix("batch=") not in players:
                delete_folder(self.spark, f"{self.root}/players/{name}")
        for number in dropped:
            delete_folder(self.spark, f"{self.root}/manifest/{number:012d}.json")

    # Numbers of players.

    def players(self, manifest: dict) -> DataFrame:
        layout = "player_id string, number bigint"
        paths = [f"{self.root}/players/batch={name}" for name in manifest["players"]]
        return self.spark.read.schema(layout).parquet(*paths) if paths else self.spark.createDataFrame([], layout)

    def number_players(self, batch: int, ids: DataFrame, before: dict) -> dict:
        """Number the distinct ``ids`` that have none yet, from 1 on without gaps; returns the manifest so far."""
        spark, folder = self.spark, f"{self.root}/players/batch={batch}"
        known = self.players(before)
        ids = ids.filter("player_id is not null").distinct()
        # The batch's ids are few beside the dictionary: they are looked up in it, which moves neither if they are broadcast.
        met = known.join(ids, "player_id").select("player_id")
        new = ids.join(met, "player_id", "left_anti").withColumn("part", F.spark_partition_id())
        # Each task numbers its own; the tasks before it tell where it begins. The parts are written
        # first, as a row must stay in its part.
        new.write.mode("overwrite").parquet(f"{folder}.new")
        dealt = spark.read.schema("player_id string, part int").parquet(f"{folder}.new")
        counts = sorted(tuple(row) for row in dealt.groupBy("part").agg(F.count(F.lit(1))).collect())
        total = sum(n for _, n in counts)
        if total:
            begins = dict(zip([part for part, _ in counts], accumulate([0, *[n for _, n in counts]])))
            begin = F.create_map(*[F.lit(x) for pair in begins.items() for x in pair])[F.col("part")]
            place = F.row_number().over(Window.partitionBy("part").orderBy("player_id"))
            dealt.select("player_id", (F.lit(before["numbered"]) + begin + place).cast("bigint").alias("number")).write.mode(
                "overwrite").parquet(folder)
        delete_folder(spark, f"{folder}.new")
        held = before["players"]
        if len(held) >= LOOSE_PLAYERS:
            known.write.mode("overwrite").parquet(f"{self.root}/players/batch=base-{batch}")
            held = [f"base-{batch}"]
        return {**before, "players": [*held, str(batch)] if total else held, "numbered": before["numbered"] + total}

    def with_numbers(self, rows: DataFrame, manifest: dict) -> DataFrame:
        """The place of each row's player: ``bucket`` and ``bit``, null without a player."""
        ids = rows.select("player_id").distinct()
        numbered = rows.join(self.players(manifest).join(ids, "player_id"), "player_id", "left")
        return numbered.withColumns({
            "bucket": F.bitmap_bucket_number("number"), "bit": F.bitmap_bit_position("number")}).drop("number", "player_id")
