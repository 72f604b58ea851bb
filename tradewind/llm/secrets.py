"""Secrets in texts: what looks like a credential, and who else has it.

Built-in functions only. Candidates of three kinds are found by pattern, leftmost and not overlapping
within a kind: ``assign`` (a keyword, then = or :, then a value of 6 or more characters), ``access``
(AKIA and 16 or more capitals or digits) and ``hex`` (24 or more lower-case hexadecimal digits). A
span is the whole match, in code points, end exclusive.

What a candidate is worth shows in its owners over the whole corpus: the SHA-256 of every candidate
value is counted by the distinct repositories and owners it appears in. A value of ``wide_owners``
owners or more, or a placeholder of one repeated character, is a widely copied example; a value of
one owner is that owner's own and looks live. The method adds a span of kind ``live`` around each
value that is one owner's own; base spans stay.

Counting is by value and owner first, then by value, both with partial sums, so a value that a third
of the documents hold adds one row per task. The verdicts come back to the candidates by a join on
the hash, which adaptive execution can split; documents without candidates take part in no shuffle.

Nulls count as empty texts. A null ``doc_id`` keeps its row, a null owner is an owner of its own.
Every row is a repository if no repository column is given; repeated rows come out repeated. An empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.storage import stored

# The patterns of the three kinds. Hexadecimal runs and keys are matched as whole runs,
# so their least length can stand in the pattern; a short assignment still uses up what it matches.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "live")
REPEATED = r"^(.)\1+$"
LEAST_VALUE = 6
WIDE_OWNERS = 3


def _found(text: Column, kind: str, pattern: str, value_group: int) -> Column:
    """Array of (start, end, kind, value, value_start) of all matches of a pattern."""
    regex = F.lit(pattern)
    matches = F.regexp_extract_all(text, regex, 0)
    values = F.regexp_extract_all(text, regex, value_group) if value_group else matches
    gaps = F.split(text, pattern, -1)
    cells = F.arrays_zip(matches.alias("m"), values.alias("v"), F.slice(gaps, 1, F.size(matches)).alias("g"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, cell: Column) -> Column:
        begin = state["at"] + F.length(cell["g"])
        end = begin + F.length(cell["m"])
        # The value ends the match.
        span = F.struct(
            begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), cell["v"].alias("value"),
            (end - F.length(cell["v"])).alias("value_start"),
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    spans = F.aggregate(cells, start, step, lambda state: state["spans"])
    spans = F.filter(spans, lambda s: F.length(s["value"]) >= LEAST_VALUE)
    # Most texts have no match: nothing is built for them.
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPANS))


_SPANS = "array<struct<start:int,end:int,kind:string,value:string,value_start:int>>"


def candidates(text: Column) -> Column:
    """All base spans of a text."""
    return F.concat(_found(text, "assign", ASSIGN, 2), _found(text, "access", ACCESS, 0), _found(text, "hex", HEX, 0))


def ownership(found: DataFrame) -> DataFrame:
    """``hash, n_repositories, n_owners`` of (hash, repository, owner) rows."""
    by_repository = found.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n_repositories"))
    return by_owner.groupBy("hash").agg(
        F.sum("n_repositories").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners")
    )


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def _joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans by start, then kind as listed."""
    keyed = F.transform(
        F.filter(spans, lambda s: s["kind"].isin(*kinds)),
        lambda s: F.struct(s["start"].alias("start"), _order(s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(
    docs: DataFrame, owner: str = "source", repository: str | None = None, wide_owners: int = WIDE_OWNERS
) -> DataFrame:
    """Per document: base counts and digest, all spans, and how many values are live or examples.

    ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, owners, repositories``
    (the last two: how many hold each base span's value, kind by kind as listed).
    """
    scanned = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        candidates(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("found"),
        F.col(owner).cast("string").alias("owner"),
        (F.col(repository).cast("string") if repository else F.lit(None).cast("string")).alias("repository"),
        F.monotonically_increasing_id().alias("row"),
    )
    scanned = stored(scanned, "candidates")
    of_row = F.col("repository") if repository else F.col("row").cast("string")
    cells = scanned.filter(F.size("found") > 0).select(
        "row", "owner", of_row.alias("repository"), F.posexplode("found").alias("place", "span")
    )
    cells = cells.withColumn("hash", F.sha2("span.value", 256))
    verdict = (
        F.when(F.col("n_owners") >= wide_owners, "example")
        .when(F.col("span.value").rlike(REPEATED), "example")
        .when(F.col("n_owners") == 1, "live")
    )
    judged = (
        cells.join(ownership(cells), "hash")
        .groupBy("row")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "place", "n_owners", "n_repositories", verdict.alias("verdict"), F.col("span.value_start").alias("start"),
                        F.col("span.end").alias("end"),
                    )
                )
            ).alias("judged")
        )
    )
    whole = scanned.drop("owner", "repository").join(judged, "row", "left")
    whole = whole.withColumn("judged", F.coalesce("judged", F.array().cast(judged.schema["judged"].dataType)))
    live = F.filter("judged", lambda x: x["verdict"] == "live")
    added = F.array_distinct(
        F.transform(
            live,
            lambda x: F.struct(
                x["start"].alias("start"), x["end"].alias("end"), F.lit("live").alias("kind"), F.lit("").alias("value"),
                x["start"].alias("value_start"),
            ),
        )
    )
    kinds = F.transform("found", lambda s: s["kind"])
    of_kind = {k: (F.size("found") - F.size(F.array_remove(kinds, k))).cast("long") for k in KINDS[:3]}
    return whole.select(
        "doc_id",
        *[of_kind[k].alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_joined(F.col("found"), KINDS[:3]), 256).alias("base_sha256"),
        _joined(F.concat("found", added), KINDS).alias("spans"),
        F.size(live).cast("long").alias("n_live"),
        F.size(F.filter("judged", lambda x: x["verdict"] == "example")).cast("long").alias("n_example"),
        F.transform("judged", lambda x: x["n_owners"]).alias("owners"),
        F.transform("judged", lambda x: x["n_repositories"]).alias("repositories"),
    )
