"""Line dedup by an exact set-similarity join, in DataFrame functions only.

A line's tokens are its distinct words (runs other than ASCII white space). A line is removed if a line that stands
earlier, in the order of doc_id and then of lines, has a token set of Jaccard similarity ``threshold`` or more.
Lines are judged on the input, not on what is left; lines without tokens stay.

Lines of equal token sets form one class, which its earliest line stands for. Tokens are ordered by rarity: their
hashes are counted over all texts in a table of fixed size, and a token's code is the level of its bucket's count
followed by 58 bits of its hash, so codes sort from rare to frequent. Two sets that are similar enough share a token
among the first few codes (the prefix). Classes meet on those, and length and positional filters, a map of marks that
each token flips one of (64, or 128 for lines of many tokens), and the number of prefix tokens that a pair shares drop pairs that can't reach the
threshold. What remains is verified on the whole token sets, by 64-bit hashes.

Large groups: how long a prefix must be depends on both sizes. Tokens that stand often in the corpus are therefore joined
by size groups as well, each class with the prefix that the two sizes need. Lines of one template that differ in as many
rare words as keep them from being similar have only these in that prefix, so they don't meet under the template's words.
Each class first meets the earliest class of each such token and pair of size groups, which settles nearly all members of
a large group in proportion to its size; then only classes not settled by this meet the others. A token that stands fewer
than OFTEN times has fewer than OFTEN classes, so it needs neither.

A line's place is one number, its document's id times 2^31 plus its number in the document: a long where the ids' span
allows it, a decimal otherwise. Other than integer ids raise a TypeError.

Nulls: a null text stays null and has no lines. Rows with a null doc_id take no part and are returned as they are.
Repeated rows are one document and come back as often as they went in. Rows of one doc_id and other texts are documents of
their own, in the order of a hash of their texts. A document's lines are cut in time proportional to their number.
Columns besides id and text may have any names; input columns named ``n_lines`` or ``n_removed`` are replaced.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from loomwork.llm._common import Scratch, inside, mapped, outside, placed, renamed, written

THRESHOLD = 0.8
#: Buckets of the table of token counts, and how many of them are collected as one row (powers of two).
BUCKET_BITS = 18
ROW_BITS = 9
#: Levels of a count: three for two doublings.
LEVEL_BITS = 6
LEVELS = 1.5
#: Tokens that stand so often may have large groups.
OFTEN = 1024
#: Sizes of sets up to this one are groups of their own; from there on groups widen by this factor.
EXACT = 16
STEP = 1.125
#: The bit between size and place that tells that a prefix has tokens which stand often.
APART = 1 << 31
#: Lines of more tokens than this have 128 marks.
WIDE = 96
#: Lines that a document may have, and the span of ids whose places fit a long.
LINES = 1 << 31
SPAN = 1 << 32


def _check_ids(docs: DataFrame) -> None:
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError("line dedup needs integer ids")


class Places:
    """The place of each line as one number that sorts by document and line."""

    def __init__(self, docs: DataFrame):
        _check_ids(docs)
        self.kind = docs.schema["doc_id"].dataType
        low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
        self.low = low or 0
        self.long = (high or 0) - self.low < SPAN

    def split(self, docs: DataFrame) -> DataFrame:
        """(place, line) of every line."""
        each = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        if self.long:
            place = F.shiftleft(F.col("doc_id").cast("long") - F.lit(self.low), 31) + F.col("line_no")
        else:
            place = (F.col("doc_id").cast("decimal(20,0)") * F.lit(LINES) + F.col("line_no")).cast("decimal(38,0)")
        return each.select(place.alias("place"), "line")

    def named(self, places: DataFrame) -> DataFrame:
        """(doc_id, line_no) of a table of places."""
        if self.long:
            line_no = F.col("place").bitwiseAND(LINES - 1)
            doc_id = F.shiftright("place", 31) + F.lit(self.low)
        else:
            line_no = F.pmod("place", F.lit(LINES).cast("decimal(38,0)"))
            doc_id = (F.col("place") - line_no) / F.lit(LINES)
        return places.select(doc_id.cast(self.kind).alias("doc_id"), line_no.cast("int").alias("line_no"))


def _words(column: str) -> Column:
    # most lines have spaces only, and a split at one plain character needs no pattern
    others = "\t\n\x0b\f\r"
    found = reduce(or_, [F.contains(F.col(column), F.lit(c)) for c in others])
    spaced = F.when(found, F.translate(column, others, " " * len(others))).otherwise(F.col(column))
    return F.array_remove(F.split(spaced, " "), "")


def _level(count: Column) -> Column:
    return F.least(F.floor(F.log2(count) * LEVELS) + 1, F.lit((1 << LEVEL_BITS) - 1)).cast("int")


def _levels(docs: DataFrame) -> Column:
    """The level of each bucket's count of token hashes, from below zero on so that codes sort as signed numbers, as a
    constant array."""
    # lines don't matter here, and a replaced character is cheaper than a second split
    others = "\t\n\x0b\f\r"
    text = reduce(lambda c, other: F.replace(c, F.lit(other), F.lit(" ")), others, F.col("text"))
    words = docs.select(F.explode(F.split(text, " ")).alias("w")).where("w <> ''")
    counts = words.groupBy(F.xxhash64("w").bitwiseAND((1 << BUCKET_BITS) - 1).alias("bucket")).agg(F.count("*").alias("n"))
    packed = F.shiftleft(F.col("bucket").bitwiseAND((1 << ROW_BITS) - 1), LEVEL_BITS).bitwiseOR(_level(F.col("n")).cast("long"))
    rows = counts.groupBy(F.shiftright("bucket", ROW_BITS).alias("row")).agg(F.collect_list(packed).alias("levels"))
    out = [0] * (1 << BUCKET_BITS)
    for row, levels in rows.collect():
        for x in levels:
            out[(row << ROW_BITS) + (x >> LEVEL_BITS)] = x & (1 << LEVEL_BITS) - 1
    half = 1 << LEVEL_BITS - 1
    return F.split(F.lit(",".join([str(x - half) for x in out])), ",").cast("array<tinyint>")


def _least_code(count: int) -> Column:
    """No token that stands ``count`` times or more has a smaller code."""
    return F.shiftleft((_level(F.lit(count)) - (1 << LEVEL_BITS - 1)).cast("long"), 64 - LEVEL_BITS)


def _hashes() -> Column:
    return F.array_distinct(F.transform(_words("line"), lambda w: F.xxhash64(w)))


def _codes(levels: Column) -> Column:
    def code(h: Column) -> Column:
        # never null, and an array without nulls is sorted as plain numbers
        level = F.coalesce(F.get(levels, h.bitwiseAND((1 << BUCKET_BITS) - 1).cast("int")), F.lit(0).cast("tinyint"))
        return F.shiftleft(level.cast("long"), 64 - LEVEL_BITS).bitwiseOR(F.shiftrightunsigned(h, LEVEL_BITS))

    return F.sort_array(F.transform(_hashes(), code))


def _at_least(size: Column, threshold: float) -> Column:
    """The least overlap of sets whose sizes sum up to ``size`` and that are similar enough; a little is taken off
    against rounding, which the verification makes good."""
    return F.ceil(size * (threshold / (1 + threshold)) - 1e-9)


def keyed_lines(lines: DataFrame, levels: Column, threshold: float = THRESHOLD) -> DataFrame:
    """(place, k1, k2, size, low, high, prefix) of each line with tokens: two digests of its token set, the
    marks that each token flips one of, and the prefix. All marks of ``low`` and ``high`` together, taken as flips of
    one map of 64, are comparable whatever the sizes."""
    # a condition on the codes would be pushed below the projection and have them made twice
    tokens = lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select("place", _codes(levels).alias("codes"))
    size = F.size("codes")
    prefix = F.slice("codes", F.lit(1), (size - F.ceil(size * threshold - 1e-9) + 1).cast("int"))
    none = F.lit(0).cast("long")
    flip = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))
    every = F.aggregate("codes", none, lambda m, h: m.bitwiseXOR(flip(h)))
    half = F.aggregate("codes", none, lambda m, h: F.when(h.bitwiseAND(64) == 0, m).otherwise(m.bitwiseXOR(flip(h))))
    high = F.when(size > WIDE, half).otherwise(none)
    keyed = tokens.select("place", F.xxhash64("codes").alias("k1"), F.xxhash64(F.lit(7), "codes").alias("k2"), size.alias("size"), every.alias("every"), high.alias("high"), prefix.alias("prefix"))
    return keyed.select("place", "k1", "k2", "size", F.col("every").bitwiseXOR(F.col("high")).alias("low"), "high", "prefix")


def line_classes(keyed: DataFrame, repeated: DataFrame) -> DataFrame:
    """(id, size, low, high, prefix): the classes of equal token sets, named by the place of their earliest lines. Lines
    that surely have no equal are classes as they are; only the others are dealt out, one for each class of a task."""
    columns = ["place", "size", "low", "high", "prefix"]
    some = inside(keyed, repeated, F.col("k1")).groupBy("k1", "k2").agg(F.min(F.struct(columns)).alias("first")).select("first.*")
    return outside(keyed, repeated, F.col("k1")).select(columns).unionByName(some).withColumnRenamed("place", "id")


def _size_group(size: Column) -> Column:
    """The number of the group of like sizes: small sizes are groups of their own."""
    beyond = F.floor(F.log(size / EXACT) / math.log(STEP)) + EXACT
    return F.when(size <= EXACT, size).otherwise(beyond).cast("int")


def _entries(classes: DataFrame, often: bool) -> DataFrame:
    """(code, id, pos, size, at, low, high): each class under the tokens of its prefix that stand OFTEN times, or under the
    others. ``at`` packs size, whether the prefix has a token of the first kind, and place."""
    least = _least_code(OFTEN)
    apart = F.element_at("prefix", -1) >= least
    each = classes.select("id", "size", "low", "high", apart.alias("apart"), F.posexplode("prefix").alias("pos", "code"))
    at = F.shiftleft(F.col("size").cast("long"), 32).bitwiseOR(F.when(F.col("apart"), APART).otherwise(0)).bitwiseOR(F.col("pos").cast("long"))
    return each.where(F.col("code") >= least if often else F.col("code") < least).withColumn("at", at)


def _by_token(classes: DataFrame) -> DataFrame:
    """(token, id, at, low, high): each class under the tokens of its prefix that stand fewer than OFTEN times. Both sides of
    their join are this one table, so it is dealt out once. A token is named by 32 bits here; two of one name only give more
    pairs to verify."""
    return _entries(classes, often=False).select(F.hash("code").alias("token"), "id", "at", "low", "high")


def _by_sizes(classes: DataFrame, threshold: float) -> DataFrame:
    """(code, own, group, id, at, low, high): each class under the tokens of its prefix that stand OFTEN times, with the group
    of its size and each of those that the other class's size may be in: a token at place p of a set can be the first of
    enough shared ones only with sets up to some size, fewer the farther behind it stands."""
    smallest = F.ceil(F.col("size") * threshold - 1e-9)
    largest = F.floor((F.col("size") - F.col("pos")) * ((1 + threshold) / threshold) - F.col("size") + 1e-6)
    groups = F.sequence(_size_group(smallest), _size_group(F.greatest(smallest, largest)))
    own = _size_group(F.col("size")).alias("own")
    # the last token of a prefix stands most often
    some = classes.where(F.element_at("prefix", -1) >= _least_code(OFTEN))
    return _entries(some, often=True).select("code", own, F.explode(groups).alias("group"), "id", "at", "low", "high")


def _sided(often: DataFrame, *sides: str) -> DataFrame:
    """(token, id, at, low, high) of the table by sizes; ``sides`` are the columns of the later class's group and the earlier's."""
    return often.select(F.hash("code", *sides).alias("token"), "id", "at", "low", "high")


def _met(later: DataFrame, earlier: DataFrame, threshold: float) -> DataFrame:
    """Pairs of classes (token, id, at, low, high) that meet under a token and may match. Names are given behind the join, so
    that a table joined with itself is dealt out once."""
    seconds = [F.col(f"b.{c}").alias(name) for c, name in (("id", "other"), ("at", "at2"), ("low", "low2"), ("high", "high2"))]
    both = later.alias("a").join(earlier.alias("b"), F.col("a.token") == F.col("b.token")).select("a.id", "a.at", "a.low", "a.high", *seconds)
    return both.where("other < id").where(_may_match(threshold))


def _apart() -> Column:
    """Whether tokens of the pair were joined by size groups, so that not all that their prefixes share are met."""
    return F.col("at").bitwiseOR(F.col("at2")).bitwiseAND(APART) != 0


def _may_match(threshold: float) -> Column:
    """Length, positional and mark filters on a class (at, low, high) and an earlier one (at2, low2, high2)."""
    size, size2 = (F.shiftright(c, 32) for c in ("at", "at2"))
    pos, pos2 = (F.col(c).bitwiseAND(APART - 1) for c in ("at", "at2"))
    least = _at_least(size + size2, threshold)
    reach = F.least(pos, pos2) + 1 + F.least(size - pos - 1, size2 - pos2 - 1)
    # a mark in which the sets differ stands for a token that only one of them has
    low, high = F.col("low").bitwiseXOR(F.col("low2")), F.col("high").bitwiseXOR(F.col("high2"))
    apart = F.when((size > WIDE) & (size2 > WIDE), F.bit_count(low) + F.bit_count(high)).otherwise(F.bit_count(low.bitwiseXOR(high)))
    # the first token that two sets share has enough tokens behind it in both; where tokens are counted, others do as well
    begins = ~_apart() | ((size - pos >= least) & (size2 - pos2 >= least))
    return (F.least(size, size2) >= F.greatest(size, size2) * threshold - F.lit(1e-9)) & begins & (reach >= least) & (apart <= size + size2 - 2 * least)


def _paired(met: DataFrame, threshold: float) -> DataFrame:
    """The pairs (id, other), each once, whose prefixes share enough tokens. Of two sets, the one whose prefix ends first
    shares no more than what the prefixes share and what it has beyond its own. Where tokens were joined by size groups,
    one is enough."""
    sizes = [F.min(F.shiftright(c, 32)).alias(name) for c, name in (("at", "size"), ("at2", "size2"))]
    pairs = met.groupBy("id", "other").agg(F.count("*").alias("shared"), F.bool_or(_apart()).alias("one"), *sizes)
    beyond = F.ceil(F.greatest("size", "size2") * threshold - 1e-9) - 1
    enough = F.col("shared") >= _at_least(F.col("size") + F.col("size2"), threshold) - beyond
    return pairs.where(F.col("one") | enough).select("id", "other")


def _verified(scratch: Scratch, name: str, pairs: DataFrame, docs: DataFrame, places: Places, threshold: float) -> DataFrame:
    """The ids of pairs (id, other) whose whole token sets are similar enough, each once."""
    pairs = scratch.written(pairs, f"{name}_pairs")
    ends = pairs.select(F.explode(F.array("id", "other")).alias("place"))
    needed, needed_docs = mapped(ends, F.col("place")), mapped(places.named(ends), F.col("doc_id"))
    lines = places.split(inside(docs, needed_docs, F.col("doc_id")))
    # repeated rows give a line more than once
    some = inside(lines, needed, F.col("place")).dropDuplicates(["place", "line"])
    one = pairs.join(some.select(F.col("place").alias("id"), "line"), "id").select("id", "other", _hashes().alias("x"))
    both = one.join(some.select(F.col("place").alias("other"), "line"), "other").select("id", "x", _hashes().alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    alike = both.select("id", shared.alias("both"), (F.size("x") + F.size("y")).alias("all"))
    found = alike.where(F.col("both") >= (F.col("all") - F.col("both")) * threshold - F.lit(1e-9)).select("id").distinct()
    return scratch.written(found, f"{name}_settled")


def later_matches(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, line_no) of the lines of (doc_id, text) to be removed."""
    docs = docs.where("doc_id is not null")
    places = Places(docs)
    levels = _levels(docs)
    with Scratch(docs.sparkSession) as scratch:
        keyed = scratch.written(keyed_lines(places.split(docs), levels, threshold), "keyed")
        groups = keyed.groupBy("k1", "k2").agg(F.min("place").alias("first"), F.count("*").alias("n"))
        many = scratch.written(groups.where("n > 1").select("k1", "k2", "first"), "many")
        repeated = mapped(many, F.col("k1"))
        # the earliest line of a class goes if the class is settled; its others always do
        later = scratch.written(inside(keyed.select("k1", "k2", "place"), repeated, F.col("k1")).join(many, ["k1", "k2"]).where("place > first").select("place"), "later")
        classes = scratch.written(line_classes(keyed, repeated), "classes")
        scratch.drop("keyed", "many")

        often = scratch.written(_by_sizes(classes, threshold), "often")
        seconds = _sided(often, "group", "own")
        earliest = seconds.groupBy("token").agg(F.min(F.struct("id", "at", "low", "high")).alias("e")).select("token", "e.*")
        met = _met(_sided(often, "own", "group"), earliest, threshold)
        first = _verified(scratch, "first", met.select("id", "other").distinct(), docs, places, threshold)

        # under tokens that stand often, only classes that may be settled are dealt out to find those that are
        maybe = mapped(first, F.col("id"))
        open_ = outside(often, maybe, F.col("id")).unionByName(inside(often, maybe, F.col("id")).join(first, "id", "left_anti"))
        rare = _by_token(classes)
        more = _met(rare, rare, threshold).unionByName(_met(_sided(open_, "own", "group"), seconds, threshold))
        pairs = _paired(more, threshold).join(first, "id", "left_anti")
        second = _verified(scratch, "second", pairs, docs, places, threshold)
        return written(places.named(first.unionByName(second).select(F.col("id").alias("place")).unionByName(later).distinct()), "lines-removed")


def _numbered_versions(docs: DataFrame) -> DataFrame | None:
    """(doc_id, version, number) of the texts of (doc_id, text), numbered in their order, if some id has several texts."""
    docs = docs.where("doc_id is not null")
    # most tables have no such id, which their ids alone tell
    if docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return None
    versions = docs.select("doc_id", F.xxhash64("text").alias("version")).distinct()
    if versions.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return None
    return placed(versions, [F.asc("doc_id"), F.asc("version")], "number")


def _removed(docs: DataFrame, threshold: float, versions: DataFrame | None) -> DataFrame:
    """(doc_id, version, line_no) of the lines to be removed; no version where ids have one text each."""
    if versions is None:
        return later_matches(docs, threshold)
    own = docs.withColumn("version", F.xxhash64("text")).join(versions, ["doc_id", "version"])
    gone = later_matches(own.select(F.col("number").alias("doc_id"), "text"), threshold).withColumnRenamed("doc_id", "number")
    return gone.join(versions, "number").drop("number")


def _kept_marks(gone: Column) -> Column:
    """One character a line up to the last of the sorted numbers ``gone``: x for these, a blank for others."""
    before = F.concat(F.array(F.lit(-1)), gone)
    gaps = F.zip_with(gone, before, lambda i, j: F.when(i.isNotNull(), F.concat(F.repeat(F.lit(" "), i - j - 1), F.lit("x"))))
    return F.array_join(gaps, "").cast("binary")


def without_lines(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` cut down to the lines that stay, and two more columns, ``n_lines`` and
    ``n_removed``."""
    counts = ("n_lines", "n_removed")
    columns = [c for c in docs.columns if c not in counts]
    rows = docs.select([F.col(f"`{c}`") for c in columns])
    # the joined table's names must not be those of any column
    ours = "_" * (1 + max(map(len, columns)))
    doc, marks, n_gone = ours + "d", ours + "m", ours + "n"
    slim = renamed(docs, doc_id=id_col, text=text_col)
    _check_ids(slim)
    versions = _numbered_versions(slim)
    gone = _removed(slim, threshold, versions)
    version = ours + "v"
    names = {"doc_id": doc} if versions is None else {"doc_id": doc, "version": version}
    listed = gone.groupBy(*[F.col(c).alias(a) for c, a in names.items()]).agg(F.sort_array(F.collect_list("line_no")).alias("lines"))
    listed = listed.select(*names.values(), _kept_marks(F.col("lines")).alias(marks), F.size("lines").cast("long").alias(n_gone))

    text = F.col(f"`{text_col}`")
    lines = F.split(text, "\n")
    # past the last mark the part is empty
    stays = lambda _, i: F.substring(F.col(marks), i + 1, F.lit(1)) != F.lit(b"x")
    cut = F.when(F.col(marks).isNull(), text).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    n_lines = F.coalesce(F.array_size(lines), F.lit(0)).cast("long").alias("n_lines")
    out = lambda cut, n: [*[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in columns], n_lines, n.alias("n_removed")]

    # documents that lose nothing are not dealt out
    key, there = F.col(f"`{id_col}`"), F.col(doc)
    same = key == there
    if versions is not None:
        same = same & (F.xxhash64(text) == F.col(version))
        key, there = F.xxhash64(key, F.xxhash64(text)), F.xxhash64(doc, version)
    touched = mapped(listed, there)
    some = inside(rows, touched, key).join(listed, same, "left")
    return some.select(out(cut, F.coalesce(n_gone, F.lit(0).cast("long")))).unionByName(outside(rows, touched, key).select(out(text, F.lit(0).cast("long"))))
