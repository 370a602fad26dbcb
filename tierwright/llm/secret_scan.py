"""Secret scans: candidates per text, judged by who else in the corpus has them."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, read_table, store

# Fixed patterns of the base kinds, in their order, then the kinds that this method adds.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
KEYWORDS = ("passw", "secret", "token", "key")  # one of them is in every assignment
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # maximal runs, as [0-9a-f]+ has them, of 24 and more
PREFIXED = re.compile(r"(?:gh[opsur]_|github_pat_|glpat-|sk-|xox[abprs]-|npm_|AIza|eyJ)[A-Za-z0-9_.=-]{16,}")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}")
KINDS = ("assign", "access", "hex", "prefixed", "opaque")
BASE_KINDS = KINDS[:3]
# A value in at most so many owners' texts is owner-specific, in however many of their texts it is.
MAX_OWNERS = 2
MIN_BITS = 3.5

CANDIDATES = "array<struct<kind: string, first: long, last: long, value_hash: string, live_form: boolean>>"


def bits_per_char(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(value: str) -> bool:
    """Letters of both cases and digits, or hex digits, without a small repertoire."""
    mixed = bool(re.search("[a-z]", value) and re.search("[A-Z]", value) and re.search("[0-9]", value))
    return mixed and bits_per_char(value) >= MIN_BITS


def candidates(text: str | None) -> list[tuple[str, int, int, str, bool]]:
    """(kind, start, end, sha256 of the value, whether it looks like a live credential)."""
    if not text:
        return []
    found = []

    def add(kind: str, match: re.Match, value: str, live: bool) -> None:
        digest = hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()
        found.append((kind, match.start(), match.end(), digest, live))

    lower = text.lower() if "=" in text or ":" in text else ""
    if any(word in lower for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                add("assign", m, m[2], len(set(m[2])) > 4)
    # every other kind needs 19 characters without white space
    if max(map(len, text.split()), default=0) < 19:
        return found
    for m in ACCESS.finditer(text):
        if len(m[0]) >= 20:
            add("access", m, m[0], len(set(m[0][4:])) > 4)
    for m in HEX.finditer(text):
        add("hex", m, m[0], len(set(m[0])) > 4)
    for kind, pattern in (("prefixed", PREFIXED), ("opaque", OPAQUE)):
        for m in clear_of([(s, e) for _, s, e, _, _ in found], pattern.finditer(text)):
            random = looks_random(m[0])
            if random or kind == "prefixed":
                add(kind, m, m[0], random)
    return sorted(found, key=lambda c: (c[1], KINDS.index(c[0])))


def clear_of(spans: list[tuple[int, int]], matches: Iterator[re.Match]) -> Iterator[re.Match]:
    """Those of ``matches``, which come in order, that overlap none of ``spans``: one pass over both."""
    apart: list[list[int]] = []
    for first, last in sorted(spans):
        if apart and first <= apart[-1][1]:
            apart[-1][1] = max(apart[-1][1], last)
        else:
            apart.append([first, last])
    at = 0
    for m in matches:
        while at < len(apart) and apart[at][1] <= m.start():
            at += 1
        if at == len(apart) or apart[at][0] >= m.end():
            yield m


def candidate_spans(text: Column) -> Column:
    """Array of candidates of a text column."""
    names = ("kind", "first", "last", "value_hash", "live_form")

    @F.pandas_udf(CANDIDATES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[dict(zip(names, c, strict=True)) for c in candidates(t)] for t in batch], dtype=object)

    return run(text)


def ownership(spans: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each value, from rows (value_hash, owner, repository).

    Two steps, so that a value that a third of all rows hold is counted in parallel: distinct triples meet
    by all three columns, and only their partial counts by value.  A null owner or repository counts as one.
    """
    filled = spans.select(
        "value_hash",
        F.coalesce(F.concat(F.lit("+"), F.col("owner")), F.lit("-")).alias("owner"),
        F.coalesce(F.concat(F.lit("+"), F.col("repository")), F.lit("-")).alias("repository"),
    )
    pairs = filled.groupBy("value_hash", "owner", "repository").agg(F.count("*").alias("copies"))
    per_owner = pairs.groupBy("value_hash", "owner").agg(F.lit(1).alias("owners"), F.sum("copies").alias("copies"))
    owners = per_owner.groupBy("value_hash").agg(F.sum("owners").alias("n_owners"), F.sum("copies").alias("n_copies"))
    per_repository = pairs.groupBy("value_hash", "repository").agg(F.lit(1).alias("repositories"))
    repositories = per_repository.groupBy("value_hash").agg(F.sum("repositories").alias("n_repositories"))
    return owners.join(repositories, "value_hash")


def exploded(staged: DataFrame, column: str) -> DataFrame:
    spans = staged.select(f"{column}.row", f"{column}.owner", f"{column}.repository", F.explode(f"{column}.found").alias("c"))
    return spans.select("row", "owner", "repository", "c.*")


def judge(spans: DataFrame) -> DataFrame:
    """Each span with the ownership of its value and whether it is live."""
    few = F.col("n_owners") <= MAX_OWNERS
    return spans.join(ownership(spans), "value_hash").select(
        "row", "kind", "first", "last", "n_owners", "n_repositories", "n_copies", (F.col("live_form") & few).alias("live")
    )


def scan_secrets(
    docs: DataFrame,
    text_col: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
    keep: Sequence[str] | None = None,
    label: str = "secrets",
) -> tuple[DataFrame, DataFrame, str]:
    """Candidates of every text, each judged by its ownership in the whole corpus.

    Returns ``docs`` (or its columns ``keep``) stored with a row number and candidate spans, the judged spans (row number, kind,
    first, last, n_owners, n_repositories, n_copies, live), and the name of the added struct column with
    ``row`` and ``found``.  A candidate is *live* if it looks random and few owners share it,
    in however many repositories; widely copied values (examples of documentation, checksums of common files) are not.  By default
    the owner is the column ``source`` and the repository the distinct text itself, so that exact copies
    of a document count once.  Null or empty texts have no candidates; repeated rows keep a row each.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.xxhash64(text_col).cast("string") if repository is None else repository
    column = free_name(docs.columns, "_scan")
    scan = F.struct(
        F.monotonically_increasing_id().alias("row"),
        owner.cast("string").alias("owner"),
        repository.alias("repository"),
        candidate_spans(F.col(text_col)).alias("found"),
    )
    staged = store(docs.withColumn(column, scan).select(*(docs.columns if keep is None else keep), column), label)
    return staged, judge(exploded(staged, column)), column


def _joined(spans: str) -> str:
    """SQL: spans by start, then kind as listed, as kind:start:end with commas."""
    order = f"array({', '.join(repr(k) for k in KINDS)})"
    return (
        f"array_join(transform(array_sort(transform({spans}, s -> struct(s.first as a, "
        f"array_position({order}, s.kind) as k, s.last as b, s.kind as kind))), "
        "s -> concat_ws(':', s.kind, s.a, s.b)), ',')"
    )


def op4_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    staged, judged, column = scan_secrets(docs, keep=("doc_id",), label="op4")
    # the method's own kinds are reported where their owner looks like the only one
    shown = judged.filter(F.col("live") | F.col("kind").isin(*BASE_KINDS))
    per_row = shown.groupBy("row").agg(
        F.collect_list(F.struct("kind", "first", "last")).alias("shown"),
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.max("n_owners").alias("most_owners"),
        F.max("n_repositories").alias("most_repositories"),
    )
    base = ", ".join(repr(k) for k in BASE_KINDS)
    out = staged.select("doc_id", F.col(f"{column}.row").alias("row")).join(per_row, "row", "left")
    out = out.withColumn("shown", F.expr("coalesce(shown, array())"))
    counts = [F.expr(f"cast(size(filter(shown, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE_KINDS]
    return out.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(_joined(f"filter(shown, s -> s.kind in ({base}))")), 256).alias("base_sha256"),
        F.expr(_joined("shown")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("most_owners", F.lit(0)).alias("most_owners"),
        F.coalesce("most_repositories", F.lit(0)).alias("most_repositories"),
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every live candidate replaced by ``mark``; ``n_chars``, if there, follows.

    Overlapping live spans are replaced as one.  Texts without a live candidate stay untouched, widely
    copied examples too.  Columns of any name go along.
    """
    staged, judged, column = scan_secrets(docs, text_col)
    row, cuts = free_name([*docs.columns, column], "_row"), free_name([*docs.columns, column], "_live")
    spans = F.array_sort(F.collect_list(F.struct("first", "last"))).alias(cuts)
    live = judged.filter("live").groupBy(F.col("row").alias(row)).agg(spans)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans, strict=True):
            parts, at, covered = [], 0, -1
            for s in found:
                if s["first"] >= covered:
                    parts += [text[at : s["first"]], mark]
                covered = at = max(covered, s["last"])
            out.append("".join([*parts, text[at:]]))
        return pd.Series(out, dtype=object)

    clean = staged.filter(F.size(f"{column}.found") == 0).select(*docs.columns)
    touched = staged.filter(F.size(f"{column}.found") > 0).join(live, F.col(f"{column}.row") == F.col(row), "left")
    text = F.when(F.col(cuts).isNotNull(), cut(F.col(text_col), F.coalesce(cuts, F.expr("cast(array() as array<struct<first: long, last: long>>)")))).otherwise(F.col(text_col))
    changed = touched.withColumn(text_col, text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col(cuts).isNotNull(), F.length(text_col)).otherwise(F.col("n_chars")))
    return clean.unionByName(changed.select(*docs.columns))
