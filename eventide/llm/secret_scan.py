"""Secrets in texts, by an incremental ledger of blobs. SQL functions only.

Every text is addressed by its content (SHA-256). The ledger is a table of the
shared folder with one row for each scan of a blob: its address, the rules it was
held against, each with the rule's version, and what was found. A run scans only
blob and rule pairs that no row of the ledger has, so copies are scanned once and
a rule that changes is scanned alone; then the findings go back to all rows (paths)
of the input by address. A run appends one increment; if it is lost, nothing was
appended, and the next run scans the same pairs again.

Positions are code points, the end exclusive. A match is marked in the text by
two control characters, and the lengths of the pieces between marks add up to
positions. Where a text has such a character itself, another one that no rule
takes stands in for it.

Defined cases: a null text is an empty one. Rows with equal texts get equal
findings, also if they are repeated. A null id is kept. An empty table adds
an empty increment. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import saved

_OPEN, _SHUT, _OTHER = "\u0001", "\u0002", "\u0003"
#: Pieces summed in one go; growing one long array piece by piece would copy it each time.
_CHUNK = 256

LEDGER = "sha256 string, rules array<string>, findings array<struct<start:bigint,stop:bigint,kind:string>>"


@dataclass(frozen=True)
class Rule:
    """A pattern, leftmost and non-overlapping; of its matches those with a long enough group are kept."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def version(self) -> str:
        """Name of the rule as the ledger knows it; another pattern is another version."""
        content = f"{self.pattern}\n{self.group}\n{self.least}"
        return f"{self.kind}@{hashlib.sha256(content.encode()).hexdigest()[:16]}"


#: A shorter run of the characters of access or hex has no longer part inside, so a least
#: length in the pattern finds the same as dropping short matches; for assign it would not.
BASE = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@\x01-\x03]{1,64}:[^\s/@\x01-\x03]{3,64}@"),
)
RULES = BASE + MORE


def address(text: str) -> Column:
    """Content address of a text."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _pieces(text: Column, rule: Rule) -> Column:
    """The text cut at the bounds of all matches: every second piece is a match; null without one."""
    marked = F.regexp_replace(text, F.lit(rule.pattern), F.lit(f"{_OPEN}$0{_SHUT}"))
    return F.when(F.rlike(text, F.lit(rule.pattern)), F.split(marked, f"[{_OPEN}{_SHUT}]", -1))


def _spans(pieces: Column, rule: Rule) -> Column:
    """Kept matches among the pieces as (start, stop, kind)."""
    none = F.expr("CAST(array() AS array<struct<start:bigint,stop:bigint,kind:string>>)")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(False).alias("match"), none.alias("out"))

    def step(state: Column, piece: Column) -> Column:
        stop = state["at"] + F.char_length(piece)
        good = state["match"]
        if rule.least:
            good = good & (F.char_length(F.regexp_extract(piece, rule.pattern, rule.group)) >= rule.least)
        span = F.struct(state["at"].alias("start"), stop.alias("stop"), F.lit(rule.kind).alias("kind"))
        out = F.when(good, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(stop.alias("at"), (~state["match"]).alias("match"), out.alias("out"))

    def chunk(state: Column, first: Column) -> Column:
        part = F.aggregate(
            F.slice(pieces, first, F.lit(_CHUNK)),
            F.struct(state["at"].alias("at"), state["match"].alias("match"), none.alias("out")),
            step,
        )
        return F.struct(
            part["at"].alias("at"),
            part["match"].alias("match"),
            F.concat(state["out"], F.array(part["out"])).alias("out"),
        )

    outer = F.struct(start["at"].alias("at"), start["match"].alias("match"), F.expr(
        "CAST(array() AS array<array<struct<start:bigint,stop:bigint,kind:string>>>)"
    ).alias("out"))
    firsts = F.sequence(F.lit(1), F.size(pieces), F.lit(_CHUNK))
    found = F.aggregate(firsts, outer, chunk, lambda state: F.flatten(state["out"]))
    return F.when(pieces.isNotNull(), found).otherwise(none)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Rows of all increments under a ledger's folder; none if nothing was appended yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def scan_new(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
    """Append to the ledger what its rows do not cover of ``docs`` and ``rules``."""
    spark = docs.sparkSession
    known = read_ledger(spark, ledger)
    blobs = docs.select(address(text).alias("sha256"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    blobs = blobs.groupBy("sha256").agg(F.first("text").alias("text"))
    asked = F.array(*[F.lit(rule.version) for rule in rules])
    if known.isEmpty():
        todo = blobs.withColumn("rules", asked)
    else:
        done = known.groupBy("sha256").agg(F.flatten(F.collect_list("rules")).alias("done"))
        left = F.array_except(asked, F.coalesce("done", F.expr("CAST(array() AS array<string>)")))
        todo = blobs.join(done, "sha256", "left").withColumn("rules", left).where(F.size("rules") > 0)
    plain = F.replace(F.replace("text", F.lit(_OPEN), F.lit(_OTHER)), F.lit(_SHUT), F.lit(_OTHER))
    todo = todo.select("sha256", "rules", plain.alias("text"))
    cut = [
        F.when(F.array_contains("rules", rule.version), _pieces(F.col("text"), rule)).alias(f"p{k}")
        for k, rule in enumerate(rules)
    ]
    found = todo.select("sha256", "rules", *cut).select(
        "sha256",
        "rules",
        F.flatten(F.array(*[_spans(F.col(f"p{k}"), rule) for k, rule in enumerate(rules)])).alias("findings"),
    )
    found.write.mode("append").parquet(ledger)


def findings(
    docs: DataFrame,
    ledger: str,
    rules: tuple[Rule, ...] = RULES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each row's id, its content address, and the ``spans`` the ledger has for it, by start and order of the rules."""
    order = F.array(*[F.lit(rule.kind) for rule in rules])
    asked = F.array(*[F.lit(rule.version) for rule in rules])
    # Only what the present versions found counts: an old row may hold other versions as well.
    current = F.transform(F.filter("rules", lambda v: F.array_contains(asked, v)), lambda v: F.substring_index(v, "@", 1))
    rows = read_ledger(docs.sparkSession, ledger).select(
        "sha256", F.filter("findings", lambda s: F.array_contains(current, s["kind"])).alias("spans")
    )
    # Runs that overlap may both have scanned a blob.
    state = rows.groupBy("sha256").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
    sorted_spans = F.array_sort(
        F.transform(
            "spans",
            lambda s: F.struct(s["start"], F.array_position(order, s["kind"]).alias("rank"), s["stop"], s["kind"]),
        )
    )
    state = state.select("sha256", sorted_spans.alias("spans")).where(F.size("spans") > 0)
    # A table between, so that Spark can split the rows of one text in the join.
    state = saved(state, "findings")
    paths = docs.select(doc_id, address(text).alias("sha256"))
    empty = F.expr("CAST(array() AS array<struct<start:bigint,rank:bigint,stop:bigint,kind:string>>)")
    return paths.join(state, "sha256", "left").select(
        doc_id, "sha256", F.coalesce("spans", empty).alias("spans")
    )
