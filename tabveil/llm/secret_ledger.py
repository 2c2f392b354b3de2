"""Secret scans over every version of every path, through an incremental ledger of blobs.

A blob is a content, addressed by its SHA-256. The ledger (Parquet, append only) has a row for each
blob and rule version that has been scanned, with the spans found. A scan addresses all versions, takes
the blobs and rule versions that the ledger lacks, reads each such content once however many paths hold
it (from the version whose keys have the smallest hash; repeated rows are read as often as they occur), appends what it
finds, and joins the findings back to all paths and versions.

Spans are code points, end exclusive. A rule is a pattern, matched leftmost and without overlaps,
whose matches are kept if a group is long enough. Spans come from JVM functions: matches are set between
marks, and the lengths of the parts add up. The mark is U+0001; in the text it is read as U+0002, so
a pattern has to treat both alike.

Null content counts as empty. Null paths and repeated rows are versions like others. Empty tables give no
rows. Versions of other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabveil.llm.common import content, stage

MARK, INSTEAD = "\x01", "\x02"

SPANS = "array<struct<start:bigint,end:bigint>>"
LEDGER = f"blob string, kind string, version string, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """``probe``: a pattern that finds something in every text with a kept match; a cheaper first look."""

    kind: str
    version: str
    pattern: str
    probe: str
    group: int = 0
    least: int = 1


# The patterns of the base detectors (assign, access, hex), as given, and two more.
# A run of hex digits, or of an access key's characters, that is long enough is the same match
# whether the pattern or a test afterwards asks for the length.
RULES = (
    Rule(
        "assign", "1",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"""(?i)(?:passw(?:or)?d|secret|token|api_?key)["']?\x20*[:=]""", group=2, least=6,
    ),
    Rule("access", "1", r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]{16}", least=20),
    Rule("hex", "1", r"[0-9a-f]{24,}", r"[0-9a-f]{24}", least=24),
    Rule("pem", "1", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule(
        "jwt", "1", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", r"eyJ[A-Za-z0-9_-]+\.eyJ",
    ),
)
BASE = ("assign", "access", "hex")


def spans_of(body: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of the rule's kept matches."""
    marked = F.regexp_replace(F.translate(body, MARK, INSTEAD), rule.pattern, f"{MARK}$0{MARK}")
    numbered = F.transform(F.split(marked, MARK), lambda part, i: F.struct(part.alias("part"), i.alias("i")))

    def kept(part: Column) -> Column:
        value = F.regexp_extract(part, rule.pattern, rule.group) if rule.group else part
        return F.length(value) >= rule.least

    def step(a: Column, x: Column) -> Column:
        after = a["at"] + F.length(x["part"])
        span = F.array(F.struct(a["at"].alias("start"), after.alias("end")))
        found = F.when((x["i"] % 2 == 1) & kept(x["part"]), F.concat(a["out"], span)).otherwise(a["out"])
        return F.struct(after.alias("at"), found.alias("out"))

    none = F.array().cast(SPANS)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))
    return F.when(F.regexp_like(body, F.lit(rule.probe)), F.aggregate(numbered, start, step)["out"]).otherwise(none)


def rule_rows(rules: tuple[Rule, ...]) -> Column:
    return F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger)


def address(versions: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``blob`` of each version."""
    return versions.select(*keys, F.sha2(content(text), 256).alias("blob"))


def scan(
    versions: DataFrame, ledger: str, keys: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Bring the ledger up to date; return (keys, blob) of every version."""
    spark = versions.sparkSession
    addressed = stage(address(versions, keys, text), "addressed")
    # The ledger exists from here on, if only without rows.
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)
    # One version of each blob holds its content for the scan, so the copies of a frequent blob meet in no task.
    held = addressed.groupBy("blob").agg(F.min(F.xxhash64(*keys)).alias("holder"))
    due = held.select("blob", "holder", F.explode(rule_rows(rules)).alias("rule")).select(
        "blob", "holder", "rule.*"
    ).join(read_ledger(spark, ledger).select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
    due = stage(due.groupBy("blob", "holder").agg(F.collect_set("kind").alias("due")), "due")
    contents = versions.select(
        F.sha2(content(text), 256).alias("blob"), F.xxhash64(*keys).alias("holder"), content(text).alias("body")
    )
    # Contents stream past the short rows of what is due; they are neither sorted nor kept.
    unseen = contents.join(due.hint("shuffle_hash"), ["blob", "holder"])
    found = F.array(*[
        F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
            F.when(F.array_contains("due", r.kind), spans_of(F.col("body"), r)).alias("spans"),
        )
        for r in rules
    ])
    scanned = unseen.select("blob", found.alias("all")).dropDuplicates(["blob"])
    scanned.select("blob", F.explode("all").alias("f")).select("blob", "f.*").where("spans is not null").write.mode(
        "append"
    ).parquet(ledger)
    return addressed


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans array<struct<start, place, kind, end>>) of blobs with findings, in order."""
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = F.array_contains(rule_rows(rules), F.struct("kind", "version"))
    hits = read_ledger(spark, ledger).where(current & (F.size("spans") > 0))
    listed = hits.select("blob", F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), place[F.col("kind")].alias("place"), F.col("kind").alias("kind"), s["end"].alias("end")
    )).alias("part"))
    # At most one array for each rule.
    return listed.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("part"))).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan_paths(
    versions: DataFrame, ledger: str, keys: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """(keys, blob, spans) of every version, after an incremental scan; no findings: an empty array."""
    spark = versions.sparkSession
    addressed = scan(versions, ledger, keys, text, rules)
    found = findings(spark, ledger, rules)
    kind = "array<struct<start:bigint,place:int,kind:string,end:bigint>>"
    return addressed.join(found, "blob", "left").select(
        *keys, "blob", F.coalesce("spans", F.array().cast(kind)).alias("spans")
    )
