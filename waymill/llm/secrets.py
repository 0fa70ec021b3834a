"""Secret scans with positions, and how widely each candidate is owned across the corpus.

Everything is DataFrame functions. A pattern's matches and the gaps between them, added up, give each
match's place in code points. Candidates are the values of the base kinds and long mixed strings of other
shapes. Over the whole corpus, each candidate's hash is counted by distinct owners and distinct repositories:
widely copied ones are examples, those of few owners that look random are live, and each live value adds a span
of kind ``live``. Base spans always stay. Repositories are judged in relation to owners: those of a known owner
speak for that owner, however many they are, and those without any are limited by number.

Null texts count as empty; repeated rows are scanned one by one; null owners and repositories do not count;
equal spans of different kinds are all listed, by start and then by kind in the order of ``KINDS``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.llm.common import cut_lineage, fresh

#: Pattern, group of the value, least code points of the value. A shorter match still takes up its text.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = {
    "assign": (ASSIGN, 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    # a run of hex letters is one match, so only runs of the length wanted need to be looked at
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
#: Other long strings: a run of at least 32 that has a digit, a capital and a small letter.
RUN = "[A-Za-z0-9+/_-]"
MIXED = rf"(?<!{RUN})(?={RUN}*[0-9])(?={RUN}*[A-Z])(?={RUN}*[a-z]){RUN}{{32,}}"
#: A value of more owners, or in more repositories without a known owner, is widely copied, however many rows
#: one owner has; a live one also has so many different characters.
MAX_OWNERS, MAX_REPOSITORIES, LEAST_VARIED = 2, 9, 8
MASK = "[secret]"

SPAN = "struct<start:int,end:int,value:string>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where the value is worked out once, not anew for every element of a lambda that reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(sizes: Column) -> Column:
    """For each number of an array, the sum of those before it.

    Done by chunks of about the root of the array's length, since a lambda copies the array that it adds to.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)

    def add(state: Column, size: Column) -> Column:
        return F.struct((state["at"] + size).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

    def chunked(own: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(own)))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(own) / width).cast("int")), lambda k: F.slice(own, k * width + 1, width))

    def summed(chunks: Column) -> Column:
        before = F.aggregate(chunks, start, lambda state, c: add(state, total(c)), lambda state: state["out"])
        return F.flatten(F.zip_with(chunks, before, lambda c, first: F.transform(F.aggregate(c, start, add, lambda state: state["out"]), lambda x: x + first)))

    return bound(bound(sizes, chunked), summed)


def spans(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, value>> of a pattern's leftmost matches that do not overlap, in code points.

    The value is a group of the match, found in the match alone; only patterns without context have one.
    """
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.slice(F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), m.alias("match"))), 1, F.size(found))

    def placed(own: Column) -> Column:
        starts = running(F.transform(own, lambda s: s["gap"] + s["size"]))
        return F.zip_with(own, starts, lambda s, at: F.struct((at + s["gap"]).alias("start"), (at + s["gap"] + s["size"]).alias("end"), (F.regexp_extract(s["match"], pattern, group) if group else s["match"]).alias("value")))

    return F.when(text.rlike(pattern), bound(steps, placed)).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> dict[str, Column]:
    return {kind: F.filter(spans(text, pattern, group), lambda s: F.length(s["value"]) >= least) for kind, (pattern, group, least) in KINDS.items()}  # noqa: B023


def listed(parts: dict[str, Column]) -> Column:
    """kind:start:end of all spans, comma-joined, by start and then in the order of the kinds."""
    marks = [F.transform(own, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"))) for k, (kind, own) in enumerate(parts.items())]  # noqa: B023
    ordered = F.array_sort(F.concat(*marks))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(df: DataFrame, text_col: str, owner: Column, repository: Column, keep: list[str]) -> DataFrame:
    """Base spans and candidates of each row under a row number, written to the shared folder without texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = df.select(*keep, owner.alias("owner"), repository.alias("repository"), *[c.alias(k) for k, c in base_spans(text).items()], spans(text, MIXED).alias("mixed"))
    return cut_lineage(found.withColumn("row", F.monotonically_increasing_id()))


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, n_owners, n_repositories, n_unowned over all rows of candidates (hash, owner, repository).

    A repository is unowned if no row in which it holds the value has an owner.
    """
    owned = F.when(F.col("owner").isNotNull(), F.col("repository"))
    counts = candidates.groupBy("hash").agg(F.count_distinct("owner").alias("n_owners"), F.count_distinct("repository").alias("n_repositories"), F.count_distinct(owned).alias("n_owned"))
    return counts.select("hash", "n_owners", "n_repositories", (F.col("n_repositories") - F.col("n_owned")).alias("n_unowned"))


def judged(found: DataFrame) -> DataFrame:
    """row, span, varied, copied, n_owners, n_repositories for each candidate's value span: whether it looks random, whether it is widely copied."""
    value_span = lambda s: F.struct((s["end"] - F.length(s["value"])).alias("start"), s["end"].alias("end"), s["value"].alias("value"))
    values = F.concat(F.transform("assign", value_span), "access", "hex", "mixed")
    each = found.select("row", "owner", "repository", F.explode(values).alias("span")).withColumn("hash", F.sha2(F.col("span.value").cast("binary"), 256))
    varied = F.size(F.array_distinct(F.split("span.value", ""))) >= LEAST_VARIED
    copied = (F.col("n_owners") > MAX_OWNERS) | (F.col("n_unowned") > MAX_REPOSITORIES)
    counts = ownership(each).select("hash", "n_owners", "n_repositories", copied.alias("copied"))
    return each.select("row", "span", "hash", varied.alias("varied")).join(counts, "hash").drop("hash")


def secret_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id") -> DataFrame:
    """id, counts of each base kind, digest of the base spans, all spans, the number of live ones, and each candidate's ownership.

    That is verdict:start:end:n_owners:n_repositories of each value span, by start and then end, comma-joined; the verdict
    is ``example`` for widely copied values, ``live``, or ``plain`` for others that don't look random.
    """
    own = fresh("id")
    found = scanned(df.withColumn(own, F.col(id_col)), text_col, F.col(owner_col), F.col(repository_col), [own])
    verdict = F.when(F.col("copied"), F.lit("example")).when(F.col("varied"), F.lit("live")).otherwise(F.lit("plain"))
    mark = F.struct("span.start", "span.end", verdict.alias("verdict"), "n_owners", "n_repositories")
    marks = judged(found).groupBy("row").agg(F.array_sort(F.collect_set(mark)).alias("marks"))
    live = F.transform(F.filter("marks", lambda m: m["verdict"] == "live"), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
    live = F.coalesce(live, F.array().cast("array<struct<start:int,end:int>>"))
    counted = F.transform("marks", lambda m: F.concat_ws(":", m["verdict"], *[m[c].cast("string") for c in ("start", "end", "n_owners", "n_repositories")]))
    base = {k: F.col(k) for k in KINDS}
    return found.join(marks, "row", "left").select(
        F.col(own).alias(id_col),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(base | {"live": live}).alias("spans"),
        F.size(live).cast("long").alias("n_live"),
        F.coalesce(F.array_join(counted, ","), F.lit("")).alias("ownership"),
    )


def masked(text: Column, found: Column, mask: str = MASK) -> Column:
    """The text with each span of an array of (start, end), sorted by start, replaced; overlapping spans become one.

    Done by blocks of about the root of the text's length, since each cut of a string reads it from its start.
    """
    def step(own: Column, first: Column) -> Callable[[Column, Column], Column]:
        # a span that began in an earlier block, or inside the one before, has its mask already
        def add(state: Column, s: Column) -> Column:
            gap = F.substring(own, state["at"] - first + 1, F.greatest(F.lit(0), s["start"] - state["at"]))
            out = F.when((s["start"] < first) | (s["start"] < state["at"]), F.lit("")).otherwise(F.concat(gap, F.lit(mask)))
            return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], out).alias("out"))

        return add

    def cut(found: Column, first: Column, width: Column) -> Column:
        inside = F.filter(found, lambda s: (s["start"] < first + width) & (s["end"] > first))
        start = F.struct(first.alias("at"), F.lit("").alias("out"))
        rest = lambda own: lambda s: F.concat(s["out"], F.substring(own, s["at"] - first + 1, width))
        return bound(F.substring(text, first + 1, width), lambda own: F.aggregate(inside, start, step(own, first), rest(own)))

    def blocks(found: Column) -> Column:
        def joined(size: Column) -> Column:
            return bound(F.greatest(F.lit(1024), F.ceil(F.sqrt(size))).cast("int"), lambda width: F.array_join(F.transform(F.transform(F.sequence(F.lit(0), F.floor(size / width).cast("int")), lambda k: k * width), lambda first: cut(found, first, width)), ""))

        return bound(F.length(text), joined)

    return F.when(F.size(found) > 0, bound(found, blocks)).otherwise(text)


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id") -> DataFrame:
    """The same rows with each base and live span masked; null texts stay null.

    A live value outside the base kinds is found again in each text by the pattern, and looked up by its hash,
    so texts are never moved unless they hold such a string. What is looked up is joined back by the text's own
    hash, not by its row, so it fits in whatever order the rows come when a task runs again.
    """
    found = scanned(df, text_col, F.col(owner_col), F.col(repository_col), [])
    distinct = lambda rows: rows.select(F.col("span.value").alias("value")).distinct()
    live = judged(found).where(F.col("varied") & ~F.col("copied"))
    only_mixed = distinct(found.select(F.explode("mixed").alias("span"))).join(distinct(live), "value", "left_semi")
    text, key, value, spot = F.col(text_col), fresh("key"), fresh("value"), fresh("spot")
    base, mixed = fresh("base"), fresh("mixed")
    none = F.array().cast("array<struct<start:int,end:int>>")
    places = lambda own: F.transform(own, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    marked = df.withColumn(base, F.coalesce(F.concat(*[places(c) for c in base_spans(text).values()]), none)).withColumn(mixed, spans(text, MIXED))
    plain = marked.where(F.coalesce(F.size(mixed), F.lit(0)) <= 0)
    looked = marked.where(F.size(mixed) > 0).withColumn(key, F.sha2(text.cast("binary"), 256))
    hits = looked.select(key, F.explode(mixed).alias(spot)).withColumn(value, F.col(f"{spot}.value")).join(cut_lineage(only_mixed).withColumnRenamed("value", value), value, "left_semi")
    hits = hits.groupBy(key).agg(places(F.collect_set(spot)).alias(spot))
    joined = looked.join(hits, key, "left").withColumn(base, F.concat(base, F.coalesce(spot, none)))
    every = plain.select(*df.columns, base).unionByName(joined.select(*df.columns, base))
    return every.withColumn(text_col, masked(text, F.array_sort(base))).select(*df.columns)
