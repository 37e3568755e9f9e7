"""Secret scans with an incremental ledger of blobs.

Every version of every text is addressed by the hash of its content, so a blob is scanned once
however many paths and versions hold it. The ledger remembers which rules, each with a version,
have seen which blob; a scan takes only blob and rule-version pairs that it doesn't have, and
findings are joined back to all rows that hold the blob. Scans append to the ledger; if one fails,
the next takes up what is missing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bloom
from tidemark.llm.words import lean, small_batches
from tidemark.sources.files import scratch_path, snapshot


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of a pattern, of which `group` has `least` characters or more."""

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: In the order in which spans of the same start are listed. The first three are the base rules.
RULES = (
    Rule(
        "assign",
        1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=8,
        group=2,
        any_case=True,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", 1, r"[0-9a-f]{32,}", least=32),
    Rule("private_key", 2, r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("web_token", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
    Rule("prefixed", 1, r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})"),
    Rule("in_url", 2, r"\b[a-z][a-z0-9+.-]{1,20}://[^\s:/@]++:[^\s:/@]{3,}+@"),
)
SPANS = "array<struct<kind: string, start: int, stop: int>>"


def find_spans(text: str, rules: tuple[Rule, ...], compiled: dict[str, re.Pattern]) -> list[dict]:
    found = []
    for place, rule in enumerate(rules):
        for match in compiled[rule.name].finditer(text):
            begin, end = match.span(rule.group)
            if end - begin >= rule.least:
                found.append((match.start(), place, match.end(), rule.kind))
    return [{"kind": kind, "start": start, "stop": stop} for start, _, stop, kind in sorted(found)]


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, unless: Broadcast | None = None) -> DataFrame:
    """blob, rules, spans of rows (blob, text, rules: names of the rules to apply).

    `unless` is a sent filter: rows whose hash, a further column h, it may have are left out.
    """

    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {r.name: re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0)) for r in rules}
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            if unless is not None:
                batch = batch.filter(pa.array(~unless.value.has(batch.column("h").to_numpy().view(np.uint64))))
            spans = []
            for text, names in zip(batch.column("text"), batch.column("rules"), strict=True):
                wanted = set(names.as_py())
                spans.append(find_spans(text.as_py() or "", tuple(r for r in rules if r.name in wanted), compiled))
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), batch.column("rules"), pa.array(spans, kind)], ["blob", "rules", "spans"]
            )

    hashed = [] if unless is None else ["h"]
    return blobs.select("blob", "text", "rules", *hashed).mapInArrow(rows, f"blob string, rules array<string>, spans {SPANS}")


class Ledger:
    """Table of (blob, rules, spans): one row for each scan of a blob."""

    SCHEMA = f"blob string, rules array<string>, spans {SPANS}"

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        # Not from a Python list, which would start workers of another kind that stay with the executors.
        empty = spark.range(0).select(F.lit(None).cast(f"struct<{self.SCHEMA}>").alias("row")).select("row.*")
        empty.write.mode("append").parquet(folder)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.folder)

    def seen(self) -> DataFrame:
        """blob, seen: names of all rules that have seen it."""
        return self.read().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen"))

    def append(self, scanned: DataFrame) -> None:
        scanned.select("blob", "rules", "spans").write.mode("append").parquet(self.folder)


def _blob(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def update(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks; returns (doc_id, blob) of every row of docs (doc_id, text).

    Rows whose blob is surely no other row's and surely unseen are scanned where they are. The rest is
    joined with one row for each unseen blob, so texts of seen blobs and further copies are never scanned.
    """
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blob = _blob(F.col("text"))
    paths = docs.select("doc_id", blob.alias("blob"))
    wanted = F.array(*[F.lit(r.name) for r in rules])
    seen = ledger.seen()
    counted = snapshot(paths.groupBy("blob").agg(F.min("doc_id").alias("at"), F.count("*").alias("rows")), scratch_path(docs.sparkSession, "blobs"))
    special = counted.filter("rows > 1").select("blob").union(seen.select("blob")).select(F.xxhash64("blob").alias("h"))
    known = docs.sparkSession.sparkContext.broadcast(bloom.build(special, "h"))
    maybe = docs.filter(bloom.may_have(F.xxhash64(blob), known))
    missing = (
        counted.join(seen, "blob", "left")
        .withColumn("rules", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
        .filter("size(rules) > 0")
        .select("at", F.col("blob").alias("wanted"), "rules")
    )
    texts = maybe.join(missing, F.col("doc_id").eqNullSafe(F.col("at"))).filter(blob == F.col("wanted"))
    texts = texts.select(F.col("wanted").alias("blob"), "text", "rules")
    # The scan itself leaves out the rows of `maybe`, so that a task has one Python worker.
    fresh = docs.select(blob.alias("blob"), "text", wanted.alias("rules"), F.xxhash64(blob).alias("h"))
    ledger.append(scan(fresh, rules, unless=known).union(scan(texts, rules)))
    return paths


def findings(paths: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, blob, spans of every path; spans by start, then in the order of the rules."""
    kinds = F.create_map(*[x for place, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(place))])
    found = ledger.read().filter("size(spans) > 0").select("blob", F.explode("spans").alias("s")).select("blob", "s.*")
    placed = F.struct(F.col("start"), kinds[F.col("kind")].alias("place"), F.col("stop"), F.col("kind"))
    found = found.filter(F.col("kind").isin([r.kind for r in rules])).groupBy("blob").agg(F.sort_array(F.collect_set(placed)).alias("spans"))
    spans = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    # A further join column has both sides shuffled, so that a blob of very many paths can be split.
    hashed = lambda df: df.withColumn("_hash", F.xxhash64("blob"))
    return hashed(paths).join(hashed(found), ["blob", "_hash"], "left").select(
        "doc_id", "blob", F.coalesce(spans, F.array().cast(SPANS)).alias("spans")
    )


def secret_spans(docs: DataFrame, ledger_folder: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, blob, spans for every row of docs (doc_id, text).

    A span is (kind, start, stop) in code points, stop excluded. With `ledger_folder`, a folder that all
    executors share, later calls scan only what is new. Null texts count as empty and have no spans.
    Repeated rows and ids each get their result; an empty table gives none.

    A rule whose version rises is applied anew, and its findings are added to those of the old version.
    """
    ledger = Ledger(docs.sparkSession, ledger_folder or scratch_path(docs.sparkSession, "ledger"))
    return findings(update(docs, ledger, rules), ledger, rules)


def written(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:stop, comma-joined."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every found span replaced by its kind in brackets; overlapping spans count once."""
    zero = F.struct(F.lit("").alias("done"), F.lit(0).alias("upto"))
    step = lambda s, x: F.when(x["stop"] <= s["upto"], s).otherwise(
        F.struct(
            F.concat(
                s["done"],
                F.when(
                    x["start"] >= s["upto"],
                    F.concat(F.substring(text, s["upto"] + 1, x["start"] - s["upto"]), F.lit("["), x["kind"], F.lit("]")),
                ).otherwise(F.lit("")),
            ).alias("done"),
            x["stop"].alias("upto"),
        )
    )
    rest = lambda s: F.concat(s["done"], F.substring(text, s["upto"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, zero, step, rest))
