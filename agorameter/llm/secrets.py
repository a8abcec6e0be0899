"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Every text is matched against the patterns below. The digests of the candidates are counted by
distinct repositories and owners over the whole corpus: a string that many owners hold is a
copied example, one that a single owner holds and that looks random is taken for live.

Nulls and edge cases: a null text counts as empty; null repositories and owners are values of
their own; rows that repeat an id are scanned one by one; an empty table gives an empty result;
only the named columns are read, so extra columns can have any name.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorameter.functions.text import expand_once
from agorameter.llm.common import cut, empty_safe


class Kind(NamedTuple):
    name: str
    pattern: str
    #: A text that does not match this holds no match of the pattern.
    gate: str
    #: The group that holds the secret, and its least length.
    group: int = 0
    least: int = 0
    base: bool = False


ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
KINDS = (
    Kind(
        "assign",
        ASSIGN,
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
        2,
        8,
        base=True,
    ),
    Kind("access", "AKIA[A-Z0-9]{12,}", "AKIA", base=True),
    Kind("hex", "[0-9a-f]{32,}", "[0-9a-f]{32}", base=True),
    # Formats that issuers document. They count only where the corpus says live.
    Kind("github", "gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_"),
    Kind("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", "xox[abprs]-"),
    Kind("google", "AIza[0-9A-Za-z_-]{35}", "AIza"),
    Kind("stripe", "[rs]k_live_[0-9A-Za-z]{16,}", "k_live_"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ"),
    Kind(
        "pem",
        # Up to its end mark, or else the lines of a key: one of 40 characters, others of 20.
        r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]++-----END [A-Z ]{0,20}PRIVATE KEY-----"
        r"|\s*[A-Za-z0-9+/]{40}[A-Za-z0-9+/=]*(?:[\r\n]+[A-Za-z0-9+/=]{20,}){0,400})",
        "PRIVATE KEY-----",
    ),
)
RANK = {kind.name: i for i, kind in enumerate(KINDS)}
SPAN = (
    "array<struct<start: bigint, end: bigint, rank: int, kind: string, base: boolean, "
    "digest: string, random: boolean>>"
)
JUDGED = (
    "array<struct<start: bigint, rank: int, end: bigint, kind: string, base: boolean, "
    "copies: bigint, owners: bigint, verdict: string>>"
)
#: Positions are summed in blocks, so a text with many matches stays linear.
BLOCK = 256
PLACEHOLDER = "(?i)example|sample|dummy|changeme|placeholder|xxxx|1234567|your[_-]"
MARK = "[SECRET]"


def looks_random(secret: Column) -> Column:
    """Many different characters, digits among letters, and no word that marks a placeholder."""
    distinct = F.size(F.array_distinct(F.split(secret, "")))
    return (
        (distinct >= 8)
        & secret.rlike("[0-9]")
        & secret.rlike("[A-Za-z]")
        & ~secret.rlike(PLACEHOLDER)
    )


def _spans(kind: Kind, hits: Column, values: Column, gaps: Column) -> Column:
    """Spans of the matches of one kind, from the matches and the text between them."""
    sizes = F.zip_with(gaps, hits, lambda g, h: F.coalesce(F.length(g) + F.length(h), F.lit(0)))

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)

    def build(bound: Column) -> Column:
        lens, offsets = bound["lens"], bound["offsets"]

        def span(hit: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            start = (
                F.get(offsets, block)
                + total(F.slice(lens, block * BLOCK + 1, i % BLOCK))
                + F.length(F.get(bound["gaps"], i))
            )
            value = F.get(bound["values"], i)
            return F.struct(
                start.alias("start"),
                (start + F.length(hit)).alias("end"),
                F.lit(RANK[kind.name]).alias("rank"),
                F.lit(kind.name).alias("kind"),
                F.lit(kind.base).alias("base"),
                F.when(F.length(value) >= kind.least, F.sha2(value, 256)).alias("digest"),
                looks_random(value).alias("random"),
            )

        return F.filter(F.transform(bound["hits"], span), lambda s: s["digest"].isNotNull())

    def with_offsets(bound: Column) -> Column:
        lens = bound["lens"]
        sums = F.transform(
            F.sequence(F.lit(0), F.floor(F.size(lens) / BLOCK).cast("int")),
            lambda b: total(F.slice(lens, b * BLOCK + 1, F.lit(BLOCK))),
        )
        offsets = F.aggregate(
            sums,
            F.array(F.lit(0).cast("long")),
            lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
        )
        return F.struct(
            bound["hits"].alias("hits"),
            bound["values"].alias("values"),
            bound["gaps"].alias("gaps"),
            lens.alias("lens"),
            offsets.alias("offsets"),
        )

    # A one-element array binds a value to a name, so that it is computed once.
    first = F.array(
        F.struct(
            hits.alias("hits"), values.alias("values"), gaps.alias("gaps"), sizes.alias("lens")
        )
    )
    return F.flatten(F.transform(F.transform(first, with_offsets), build)).cast(SPAN)


def find_spans(text: Column) -> Column:
    """Sorted spans of all kinds: by start, then by kind as listed."""
    none = F.array().cast(SPAN)
    found = [
        F.when(
            text.rlike(kind.gate),
            _spans(
                kind,
                F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)),
                F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)),
                F.split(text, kind.pattern, -1),
            ),
        ).otherwise(none)
        for kind in KINDS
    ]
    return F.array_sort(F.concat(*found))


def ownership(hits: DataFrame) -> DataFrame:
    """Copies, distinct repositories and distinct owners of each digest.

    Three aggregations, each combined before its shuffle: a string in a third of all rows
    reaches the last one as one row per task.
    """
    return (
        hits.groupBy("digest", "owner", "repository")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("digest", "owner")
        .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("repositories"))
        .groupBy("digest")
        .agg(
            F.sum("copies").alias("copies"),
            F.sum("repositories").alias("repositories"),
            F.count(F.lit(1)).alias("owners"),
        )
    )


def scan_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    repository: str = "doc_id",
    owner: str = "source",
    max_owners: int = 1,
    max_repositories: int = 3,
    carry: bool = False,
) -> DataFrame:
    """One row per document: its id and ``spans``, each with copies, owners and a verdict.

    ``verdict`` is ``live`` for a random-looking string of at most ``max_owners`` owners and
    ``max_repositories`` repositories, ``copied`` for one beyond these limits, else ``weak``.
    Base kinds are reported whatever the verdict, the others only where live. With
    ``carry`` the whole rows of documents with candidates come along as ``carried``.
    """
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(repository).alias("repository"),
        F.col(owner).alias("owner"),
        empty_safe(text).alias("text"),
        (F.struct(*docs.columns) if carry else F.lit(None)).alias("carried"),
    )
    found = rows.select(
        "key",
        "repository",
        "owner",
        "carried",
        expand_once(F.struct(find_spans(F.col("text")).alias("spans"))),
    )
    # The row number only tells repeated ids apart, and is fixed by the checkpoint.
    scanned = cut(
        found.select(
            F.monotonically_increasing_id().alias("row"),
            "key",
            "repository",
            "owner",
            F.when(F.size("spans") > 0, F.col("carried")).alias("carried"),
            "spans",
        )
    )
    hits = scanned.where(F.size("spans") > 0).select(
        "row", "repository", "owner", F.inline("spans")
    )
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    judged = (
        hits.select("row", "start", "end", "rank", "kind", "base", "digest", "random")
        .join(ownership(hits), "digest")
        .withColumn(
            "verdict",
            F.when(~live, "copied").when(F.col("random"), "live").otherwise("weak"),
        )
        .where(F.col("base") | (F.col("verdict") == "live"))
        .groupBy("row")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("start", "rank", "end", "kind", "base", "copies", "owners", "verdict")
                )
            ).alias("spans")
        )
    )
    return (
        scanned.select("row", "key", "carried")
        .join(judged, "row", "left")
        .select(
            F.col("key").alias(key),
            "carried",
            F.coalesce("spans", F.array().cast(JUDGED)).alias("spans"),
        )
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in the order of the spans."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def span_digest(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digests of the spans of :func:`scan_secrets`."""
    spans = F.col("spans")

    def of_kind(name: str):
        return lambda s: s["kind"] == name

    def count(test) -> Column:
        return F.size(F.filter(spans, test)).cast("long")

    return scanned.select(
        key,
        *(
            count(of_kind(kind.name)).alias(f"n_{kind.name}") for kind in KINDS if kind.base
        ),
        F.sha2(joined(F.filter(spans, lambda s: s["base"])), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        count(lambda s: s["verdict"] == "live").alias("n_live"),
        count(lambda s: s["verdict"] == "copied").alias("n_copied"),
    )


def _merged(spans: Column) -> Column:
    """Spans that overlap or touch, as one; sorted by start."""

    def add(acc: Column, span: Column) -> Column:
        last = F.element_at(acc, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        new = F.struct(span["start"].alias("start"), span["end"].alias("end"))
        meets = (F.size(acc) > 0) & (span["start"] <= F.get(acc, F.size(acc) - 1)["end"])
        return F.when(
            meets, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(wider))
        ).otherwise(F.concat(acc, F.array(new)))

    return F.aggregate(spans, F.array().cast("array<struct<start: bigint, end: bigint>>"), add)


def redacted(text: Column, spans: Column, mark: str = MARK) -> Column:
    """The text with each stretch covered by spans replaced by a mark."""

    def build(cuts: Column) -> Column:
        def before(span: Column, i: Column) -> Column:
            since = F.when(i > 0, F.get(cuts, i - 1)["end"]).otherwise(F.lit(0))
            return F.substring(text, (since + 1).cast("int"), (span["start"] - since).cast("int"))

        tail = F.substring(text, (F.element_at(cuts, -1)["end"] + 1).cast("int"), F.length(text))
        return F.array_join(F.concat(F.transform(cuts, before), F.array(tail)), mark)

    return F.when(F.size(spans) == 0, text).otherwise(
        F.get(F.transform(F.array(_merged(spans)), build), F.lit(0))
    )


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents with their secrets replaced; all rows and columns stay, in any order.

    Texts without any candidate pass through; the others travel whole with their spans.
    """
    clean = docs.where(F.size(find_spans(empty_safe(text))) == 0)
    scanned = scan_secrets(docs, key, text, carry=True, **settings)
    marked = scanned.where(F.col("carried").isNotNull()).select(
        *(
            (
                redacted(F.col(f"carried.`{text}`"), F.col("spans"))
                if name == text
                else F.col(f"carried.`{name}`")
            ).alias(name)
            for name in docs.columns
        )
    )
    return clean.unionByName(marked)
