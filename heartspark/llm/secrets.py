"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. A ledger keeps, for each
blob, the rules (kind and version) that it has been scanned by and what they found. A scan reads
the text of one version of each blob for which some pair of blob and rule isn't in the ledger,
runs the missing rules on it, and joins findings back to all versions by content address. Each span
carries its rule's version, and only spans of the given rules' versions are joined back.

Spans are in code points, the end exclusive, and are found by splitting the text at the matches:
lengths of pieces and matches add up to positions. Matches of a rule don't overlap and are taken
leftmost first; those shorter than the rule's minimum are dropped afterwards.

Results by definition: null texts are empty and hold no secrets; texts of any length are scanned
whole; each input row has a result row, repeated rows and rows of the same id too; an empty table
gives an empty result; further columns of the input are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import col, pick, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters. A change of the rule needs a new version."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    Rule("assign", ASSIGN, group=2, least=8),
    # Runs of a class are matched whole, so a minimum inside the pattern drops the same matches earlier.
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: A PEM key through its END line; without one, to the end of the base64 lines below the first line (also with line ends escaped as in JSON).
PEM = (r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:(?:\r?\n(?:Proc-Type|DEK-Info): [^\r\n]*){1,9}\r?\n)?"
       r"(?:[^-]*-----END [A-Z ]{0,30}PRIVATE KEY-----"
       r"|(?:\r?\n[\t\x20]*[A-Za-z0-9+/=]+[\t\x20]*\r?(?![^\n])|(?:\\r)?\\n[A-Za-z0-9+/=]{16,})*+)")
#: Fixed formats of common credentials.
MORE = (
    Rule("private_key", PEM, version=2),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE

SPAN = "struct<start:bigint,end:bigint,rank:int,kind:string,version:int>"


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's spans in a text, as an array of SPAN."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    if rule.group:
        matches = F.arrays_zip(matches.alias("whole"), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("part"))
        long = lambda m: (F.length(m["whole"]), F.length(m["part"]) >= rule.least)
    else:
        long = lambda m: (F.length(m), F.length(m) >= rule.least)
    pieces = F.transform(F.split(text, rule.pattern, -1), F.length)
    steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda gap, m: F.struct(
        gap.alias("gap"), long(m)[0].alias("n"), long(m)[1].alias("ok")))
    empty = F.lit([]).cast(f"array<{SPAN}>")

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        span = F.struct(start.alias("start"), (start + s["n"]).alias("end"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"),
                        F.lit(rule.version).alias("version"))
        return F.struct((start + s["n"]).alias("at"), F.when(s["ok"], F.array_append(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    found = F.aggregate(steps, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("found")), step, lambda acc: acc["found"])
    return F.when(text.rlike(rule.pattern), found).otherwise(empty)


def find_spans(text: Column, rules: tuple[Rule, ...] = RULES, missing: Column | None = None) -> Column:
    """All rules' spans by start, then by rank of the rule; ``missing`` names the rules to run."""
    empty = F.lit([]).cast(f"array<{SPAN}>")
    found = [spans_of(text, rule, rank) for rank, rule in enumerate(rules)]
    if missing is not None:
        found = [F.when(F.array_contains(missing, rule.name), f).otherwise(empty) for rule, f in zip(rules, found)]
    return F.concat(*found)


def by_start(spans: Column) -> Column:
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))


def scan(versions: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Findings (id, blob, spans) of every version, and the rows to add to the ledger.

    A ledger row: blob, rules (names that were run), spans (what they found). Copies of a blob may
    be any share of the rows: one is read, and the join back has a row per blob on its other side,
    so that Spark can split a common blob's rows over tasks.
    """
    rows = pick(versions, id=id_col, text=text_col).withColumn("text", text_or_empty(F.col("text")))
    rows = rows.withColumn("blob", F.sha2("text", 256))
    addressed = rows.select("id", "blob")
    todo = addressed.groupBy("blob").agg(F.min("id").alias("id"))
    every = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        todo = todo.withColumn("missing", every)
    else:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"), F.flatten(F.collect_list("spans")).alias("known"))
        todo = todo.join(seen, "blob", "left").withColumn("missing", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
        todo = todo.where(F.size("missing") > 0).select("blob", "id", "missing")
    unseen = rows.alias("r").join(todo.alias("t"), F.col("r.id").eqNullSafe(F.col("t.id")) & (F.col("r.blob") == F.col("t.blob")))
    unseen = unseen.select("t.id", "t.blob", "t.missing", "r.text").withColumn("spans", find_spans(F.col("text"), rules, F.col("missing")))
    # Rows that repeat both id and text would be scanned alike: one is kept.
    scanned = unseen.groupBy("id", "blob").agg(F.first("missing").alias("rules"), F.first("spans").alias("spans")).select("blob", "rules", "spans")
    none = F.array().cast(f"array<{SPAN}>")
    found = addressed.join(scanned.select("blob", F.col("spans").alias("new")), "blob", "left")
    spans = F.coalesce("new", none)
    if ledger is not None:
        found = found.join(seen.select("blob", "known"), "blob", "left")
        name = lambda s: F.concat_ws("@", s["kind"], s["version"])
        # Findings of rules and versions that are no longer among the given ones stay in the ledger only; ranks are the given rules'.
        known = F.filter(F.coalesce("known", none), lambda s: F.array_contains(every, name(s)))
        known = F.transform(known, lambda s: s.withField("rank", (F.array_position(every, name(s)) - 1).cast("int")))
        spans = F.concat(spans, known)
    findings = found.select(F.col("id").alias(id_col), "blob", by_start(spans).alias("spans"))
    return findings, scanned


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(findings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of the base rules' spans, and all spans joined."""
    def base(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kinds = [r.kind for r in BASE]
    return findings.select(
        id_col, *map(base, kinds), F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(kinds))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def redact(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """The text with every stretch that spans cover replaced by ``mark``; spans sorted by start."""
    def merge(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        apart = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(apart, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    whole = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), merge, lambda acc: F.concat(
        acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def redacted(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with the found secrets replaced in ``text_col``; texts without secrets, null ones too, stay as they are."""
    blob = F.sha2(text_or_empty(col(text_col)), 256)
    _, scanned = scan(docs.select(blob.alias("id"), col(text_col).alias("text")), None, "id", "text", rules)
    found = scanned.where(F.size("spans") > 0).select(F.col("blob").alias("found_blob"), by_start(F.col("spans")).alias("found_spans"))
    both = docs.select(F.struct(*[col(k) for k in docs.columns]).alias("row"), blob.alias("row_blob")).join(
        found, F.col("row_blob") == F.col("found_blob"), "left")
    text = F.when(F.col("found_spans").isNull(), F.col("row")[text_col]).otherwise(redact(F.col("row")[text_col], F.col("found_spans"), mark))
    return both.select(*[text.alias(k) if k == text_col else F.col("row")[k].alias(k) for k in docs.columns])
