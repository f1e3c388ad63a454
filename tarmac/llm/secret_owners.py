"""Secrets in whole texts, told apart by how many owners share them. DataFrame functions only.

Fixed patterns give the base spans (assign, access, hex). Other long tokens of mixed characters are candidates
too. The value of each candidate is hashed and counted over the corpus by distinct repositories and owners: what
several owners hold is a copied example, what a single owner holds looks live. Candidates outside the base
spans are added as spans of kind ``owned`` if they look live.

An owner is the value of ``owner`` (null counts as the empty text), a repository a document. Null counts as the empty
text. Repeated rows give repeated result rows and are separate repositories. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.store import keep, setup

KINDS = ("assign", "access", "hex")
ADDED = "owned"
SHARED_BY = 2  # owners from which on a value counts as a copied example

# Fixed patterns of the base spans.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
MARK, OTHER = "\ue000", "\ue001"  # the mark does not occur in texts once they are translated

FOUND = "array<struct<start:int,kind:int,end:int,value:string>>"


# Lengths summed up at a time: running sums grow an array by one, which costs its length.
STEP = 256


def _running(numbers: Column) -> Column:
    """0 and the running sums of a short array."""
    return F.aggregate(
        numbers, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))
    )


def _with_matches(docs: DataFrame, text: Column, patterns: dict[str, str]) -> DataFrame:
    """For each pattern a column with its matches as an array of (start, kind, end, value), by start.

    The text is cut at marks put around each match, and the ends of the pieces are running sums of their lengths, in
    two levels. Each step is a column of its own: what a lambda refers to is then computed once per text.
    """
    names = list(patterns)
    cut = {n: F.split(F.regexp_replace(text, p, f"{MARK}$0{MARK}"), MARK) for n, p in patterns.items()}
    docs = docs.select("row", "doc_id", "owner", *[c.alias(n) for n, c in cut.items()])

    def step(made: dict[str, Column]) -> None:
        nonlocal docs
        docs = docs.withColumns(made)

    def blocks(lengths: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(lengths), F.lit(STEP))
        return F.transform(starts, lambda i: F.slice(lengths, i, STEP))

    step({f"{n}_size": F.transform(n, F.length) for n in names})
    step({f"{n}_part": blocks(F.col(f"{n}_size")) for n in names})
    step({f"{n}_in": F.transform(f"{n}_part", _running) for n in names})
    step({f"{n}_sum": F.transform(f"{n}_in", lambda x: F.element_at(x, -1)) for n in names})
    step({f"{n}_from": _running(F.col(f"{n}_sum")) for n in names})
    step(
        {
            # The end of each piece.
            f"{n}_end": F.flatten(
                F.zip_with(
                    f"{n}_in",
                    F.slice(f"{n}_from", 1, F.size(f"{n}_in")),
                    lambda own, first: F.transform(F.slice(own, 2, STEP), lambda x: x + first),
                )
            )
            for n in names
        }
    )

    def matches(kind: int, n: str) -> Column:
        ends, pieces = F.col(f"{n}_end"), F.col(n)
        found = F.transform(
            F.sequence(F.lit(2), F.size(n) - 1, F.lit(2)),
            lambda i: F.struct(
                F.element_at(ends, i - 1).alias("start"),
                F.lit(kind).alias("kind"),
                F.element_at(ends, i).alias("end"),
                F.element_at(pieces, i).alias("value"),
            ),
        )
        return F.when(F.size(n) > 1, found).otherwise(F.array().cast(FOUND)).alias(n)

    return docs.select("row", "doc_id", "owner", *[matches(kind, n) for kind, n in enumerate(names)])


def _spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, ADDED)])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def find_candidates(docs: DataFrame, owner: str = "source") -> DataFrame:
    """Per document: base spans, and other tokens of mixed characters (also such as meet base spans); the texts
    themselves are left behind."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.translate(F.coalesce("text", F.lit("")), MARK, OTHER).alias("text"),
    )
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "more": CANDIDATE}
    found = _with_matches(rows, F.col("text"), patterns)
    assign = F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= 12)
    mixed = F.filter(
        "more",
        lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[a-z]"),
    )
    return found.select(
        "row", "doc_id", "owner", F.concat(assign, "access", "hex").alias("base"), mixed.alias("more")
    )


def _apart(found: DataFrame) -> DataFrame:
    """Rows (row, owner, start, kind, end, value): all base spans, and the other candidates that meet none of them.

    Where a document has both, one pass over its spans in the order of their starts knows for each how far base
    spans before it reach and where the next one starts.
    """
    alone = found.where((F.size("base") == 0) | (F.size("more") == 0))
    both = found.where((F.size("base") > 0) & (F.size("more") > 0))
    spans = both.select("row", "owner", F.inline(F.concat("base", "more")))
    is_base = F.col("kind") < 3
    order = Window.partitionBy("row").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    reach = F.max(F.when(is_base, F.col("end"))).over(before)
    following = F.min(F.when(is_base, F.col("start"))).over(after)
    meets = (reach > F.col("start")) | (following < F.col("end"))
    kept = spans.withColumn("meets", F.coalesce(meets, F.lit(False))).where(is_base | ~F.col("meets")).drop("meets")
    return alone.select("row", "owner", F.inline(F.concat("base", "more"))).unionByName(kept)


def owned_secrets(docs: DataFrame, owner: str = "source") -> DataFrame:
    """One row per document: counts, base_sha256, spans, and how many candidates look live or copied."""
    setup(docs.sparkSession)
    found = keep(find_candidates(docs, owner))
    one = keep(_apart(found))
    secret = F.when(F.col("kind") == 0, F.regexp_extract("value", ASSIGN, 1)).otherwise(F.col("value"))
    one = one.select("row", "owner", "start", "kind", "end", F.xxhash64(secret).alias("secret"))
    # Distinct repositories and owners of each value, in steps that are summed before they are shuffled.
    by_row = one.groupBy("secret", "owner", "row").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_row.groupBy("secret", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    stats = keep(
        by_owner.groupBy("secret").agg(
            F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories")
        )
    )
    live = F.col("owners") < SHARED_BY
    span = F.struct("start", "kind", "end")
    judged = (
        one.join(stats, "secret")
        .groupBy("row")
        .agg(
            F.count_if(live).alias("n_live"),
            F.count_if(~live).alias("n_copied"),
            F.max("repositories").alias("max_repositories"),
            F.collect_list(F.when(live & (F.col("kind") == 3), span)).alias("added"),
        )
    )
    base = F.transform("base", lambda s: F.struct(s["start"], s["kind"], s["end"]))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    joined = keep(found.select("row", "doc_id", base.alias("base"))).join(keep(judged), "row", "left")

    def number_of(kind: int) -> Column:
        # The lambda has one argument: a second one would be the element's position.
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    zero = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        *[number_of(k) for k in range(len(KINDS))],
        F.sha2(_spelled(F.col("base")), 256).alias("base_sha256"),
        _spelled(F.concat("base", F.coalesce("added", none))).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"),
        F.coalesce("n_copied", zero).alias("n_copied"),
        F.coalesce("max_repositories", zero).alias("max_repositories"),
    )
