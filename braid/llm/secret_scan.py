"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only.

Three fixed patterns find assigned, access-key-like and hexadecimal values; a wider one finds long opaque strings. The value
of every candidate is hashed and counted over the whole corpus by distinct owners, repositories and texts. A value that many
owners have, or that stands in many repositories or many different texts, is a copied example; one that stays with few looks
live. Copies of a whole text are one text, of the least owner and repository among them, so that a credential in copied
documents stays a credential. The fixed patterns' spans are always reported; the opaque strings only where they look live.

Spans are in code points, the end exclusive. Null text is empty; a null owner or repository counts as one of its own.
Repeated rows are reported each, and counted once. Work and memory are in proportion to a text's length, however many matches
it has: places are running sums over exploded matches, not arrays that grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braid.shared import written

# The patterns, in the order in which kinds are listed.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "opaque": r"[A-Za-z0-9_-]{20,}",
}
KINDS = tuple(PATTERNS)
# A value of this many owners or more is an example that people copy; so is one in this many repositories (of any owners), or
# in this many different texts, as within one large source.
EXAMPLE_OWNERS, EXAMPLE_REPOS, EXAMPLE_TEXTS = 3, 6, 20
# Texts are masked in blocks of this many code points, so that no place is looked for from a long text's start.
MASK_BLOCK = 4096


def _matches(text: Column, kind: str) -> Column:
    """Matches of a kind in their order: its number, place in the list, characters since the match before, length, and the
    value's hash, null for a match that fails the rule of its kind."""
    pattern = F.lit(PATTERNS[kind])
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.slice(F.split(text, PATTERNS[kind], -1), 1, F.size(whole))
    values = F.regexp_extract_all(text, pattern, F.lit(2)) if kind == "assign" else whole

    def match(x: Column, i: Column) -> Column:
        good = F.lit(True)
        if kind == "assign":
            good = F.char_length(x["value"]) >= 6
        if kind == "opaque":
            good = x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]")
        value = F.when(good, F.sha2(F.encode(x["value"], "UTF-8"), 256))
        step = (F.char_length(x["gap"]) + F.char_length(x["whole"])).alias("step")
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("place"), step, F.char_length(x["whole"]).alias("length"), value.alias("value"))

    none = F.expr("CAST(array() AS array<struct<kind:int,place:int,step:int,length:int,value:string>>)")
    found = F.transform(F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), values.alias("value")), match)
    return F.when(text.rlike(PATTERNS[kind]), found).otherwise(none)


def scanned(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """Per row: id, owner, repository, the text's digest where it has a match, and ``found``, the matches of all kinds."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    given = [F.col(f"`{c}`").alias(name) for c, name in ((id_col, "id"), (owner_col, "owner"), (repo_col, "repo"))]
    rows = docs.select(*given, text.alias("text"), F.concat(*[_matches(text, kind) for kind in KINDS]).alias("found"))
    return rows.select("id", "owner", "repo", F.when(F.size("found") > 0, F.md5(F.encode("text", "UTF-8"))).alias("digest"), "found")


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate value: distinct owners, repositories and texts, and occurrences. Each step sums up what the next one
    shuffles, so that a value copied everywhere is spread over its texts first."""
    each = found.select("digest", "owner", "repo", F.explode("found.value").alias("value")).filter("value IS NOT NULL")
    texts = each.groupBy("value", "digest").agg(F.min(F.struct("owner", "repo")).alias("first"), F.count("*").alias("n"))
    repos = texts.groupBy("value", "first.owner", "first.repo").agg(F.count("*").alias("texts"), F.sum("n").alias("n"))
    owners = repos.groupBy("value", "owner").agg(F.count("*").alias("repos"), F.sum("texts").alias("texts"), F.sum("n").alias("n"))
    sums = [F.sum(c).alias(c) for c in ("repos", "texts")]
    return owners.groupBy("value").agg(F.count("*").alias("owners"), *sums, F.sum("n").alias("occurrences"))


def places(found: DataFrame) -> DataFrame:
    """Per candidate: row, id, start, kind, end and value hash. A row's matches meet in one task, as its text did."""
    each = found.filter(F.size("found") > 0).select("row", "id", F.inline("found")).repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum("step").over(so_far).cast("int")).withColumn("start", F.col("end") - F.col("length")).filter("value IS NOT NULL")
    # An opaque string that a fixed pattern covers is no finding of its own: of the spans that start no later, one ends no earlier.
    reach = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    each = each.withColumn("reach", reach).filter((F.col("kind") < 3) | F.coalesce(F.col("reach") < F.col("end"), F.lit(True)))
    return each.select("row", "id", "start", "kind", "end", "value")


def _scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str, examples: tuple[int, int, int]) -> tuple[DataFrame, DataFrame]:
    """The rows by number and id, and their spans with counts and verdict. The matches are written once, without texts."""
    found = written(scanned(docs, id_col, text_col, owner_col, repo_col).withColumn("row", F.monotonically_increasing_id()), "secrets")
    few = F.lit(True)
    for name, least in zip(("owners", "repos", "texts"), examples, strict=True):
        few &= F.col(name) < least
    each = places(found).join(ownership(found).withColumn("live", few), "value")
    return found.select("row", "id"), each.filter((F.col("kind") < 3) | F.col("live"))


def secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "lang",
    example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS, example_texts: int = EXAMPLE_TEXTS,
) -> DataFrame:
    """One row per row of ``docs``: its id and ``spans``, an array of start, end, kind (a name) and the value's ``owners``,
    ``repos``, ``texts`` and ``live``."""
    rows, each = _scan(docs, id_col, text_col, owner_col, repo_col, (example_owners, example_repos, example_texts))
    names = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    span = F.struct("start", F.col("kind").alias("number"), "end", names.alias("kind"), "owners", "repos", "texts", "live")
    spans = each.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    empty = F.expr("CAST(array() AS array<struct<start:int,number:int,end:int,kind:string,owners:bigint,repos:bigint,texts:bigint,live:boolean>>)")
    return rows.join(spans, "row", "left").select(F.col("id").alias(id_col), F.coalesce("spans", empty).alias("spans"))


def _cuts(each: DataFrame) -> DataFrame:
    """Per text, a map from each block with live spans to what goes from it: start and end in the block, and whether the mark
    stands there. Of spans that overlap, the first gives the mark."""
    live = each.filter("live").select("id", "start", "end").distinct()
    before = F.max("end").over(Window.partitionBy("id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    pieces = live.withColumn("before", F.coalesce(before, F.lit(0))).filter("end > before")
    pieces = pieces.select("id", F.greatest("start", "before").alias("low"), F.col("end").alias("high"), (F.col("start") >= F.col("before")).alias("mark"))
    first, last = (F.floor(x / MASK_BLOCK).cast("int") for x in (F.col("low"), F.col("high") - 1))
    pieces = pieces.withColumn("first", first).withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.col("block") * MASK_BLOCK
    low, high = F.greatest(F.col("low") - begin, F.lit(0)), F.least(F.col("high") - begin, F.lit(MASK_BLOCK))
    part = F.struct(low.alias("low"), high.alias("high"), (F.col("mark") & (F.col("block") == F.col("first"))).alias("mark"))
    blocks = pieces.groupBy("id", "block").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return blocks.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("block", "parts"))).alias("cuts"))


def _masked(text: Column, cuts: Column, mark: str) -> Column:
    def block(x: Column, i: Column) -> Column:
        def step(state: Column, part: Column) -> Column:
            kept = F.substr(x, state["at"] + 1, part["low"] - state["at"])
            out = F.concat(state["out"], kept, F.when(part["mark"], F.lit(mark)).otherwise(F.lit("")))
            return F.struct(part["high"].alias("at"), out.alias("out"))

        parts = F.try_element_at(cuts, i)
        cut = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substr(x, s["at"] + 1)))
        return F.when(parts.isNull(), x).otherwise(cut)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{MASK_BLOCK}}}"), F.lit(0))
    return F.when(cuts.isNotNull(), F.array_join(F.transform(blocks, block), ""))


def without_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "lang",
    example_owners: int = EXAMPLE_OWNERS, mark: str = "[SECRET]", length_col: str | None = None,
    example_repos: int = EXAMPLE_REPOS, example_texts: int = EXAMPLE_TEXTS,
) -> DataFrame:
    """``docs`` with every live-looking value's span replaced by ``mark``; copied examples and all other text stay. A column of
    text lengths, if named, is set anew where a text changes.

    Which spans go depends on a text alone, so that rows with candidates meet their spans by the text's digest, and all
    other rows pass through without a shuffle.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    suspicious = F.lit(False)
    for pattern in PATTERNS.values():
        suspicious |= text.rlike(pattern)
    digest = F.sha2(F.encode(text, "UTF-8"), 256)
    some = rows.filter(suspicious)
    given = some.select(digest.alias("id"), text.alias("text"), F.col(f"row.`{owner_col}`").alias("owner"), F.col(f"row.`{repo_col}`").alias("repo"))
    _, each = _scan(given, "id", "text", "owner", "repo", (example_owners, example_repos, example_texts))
    some = some.join(_cuts(each).withColumnRenamed("id", "of"), digest == F.col("of"), "left")
    some = some.select("row", _masked(text, F.col("cuts"), mark).alias("masked"))
    row = F.col("row").withField(f"`{text_col}`", F.col("masked"))
    if length_col:
        row = row.withField(f"`{length_col}`", F.char_length("masked").cast(docs.schema[length_col].dataType))
    changed = F.when(F.col("masked").isNull(), F.col("row")).otherwise(row)
    return rows.filter(~suspicious).unionAll(some.select(changed.alias("row"))).select("row.*")
