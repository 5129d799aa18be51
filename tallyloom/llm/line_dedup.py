"""Line deduplication by a segment-partition edit join.

Lines are compared after trimming and lower-casing; equal ones become one
first. Lines within one edit of each other are then found by segments: a line
is split into threshold plus one, that is two, and a line within one edit holds
one of them unchanged. The index is length-aware: a segment is entered with the
length of its line and its place. A line probes the entries of lines of its own
length and of one less, where the segment can only stand at one place. Pairs that
meet are verified by Hyyrö's bit-parallel edit distance in a band.

When more than ``CROWDED`` lines meet on a segment, say the variants of one
sentence in many copies, they are not paired. The rest of the line, which holds
the edit, is cut into ``PARTS`` parts, and the lines meet again on all that lies
outside one of them, until the rest is a single character. Then all lines of one
length that meet are within one edit of each other, and a link to the smallest is
enough; a line one character longer is linked if that character is one of its two.
So no crowd is ever paired and no link between different lines is lost that their
class needs.

The threshold grows with the line: lines of ``LONG_WORDS`` words or more are
also near if one word is changed, added or missing, however many characters that
takes. They are joined in the same way with words in the place of characters,
so crowds of them are refined as exactly.

Of each class of lines one is kept: that in the document of smallest id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import components, maybe_in, salted_join, saved, text_version

DISTANCE = 1
CROWDED = 16
#: Shorter lines are not compared with near ones: those are near by chance.
MIN_CHARS = 24
BLANKS = " \t\r\x0b\f\u00a0\u3000"
#: Lines of so many words may differ in a whole word.
LONG_WORDS = 10


def normal(line: Column) -> Column:
    return F.lower(F.trim(line))


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


#: What a line is a sequence of: how many there are, and a stretch of them.
UNITS = ((F.length, F.substring), (F.size, F.slice))
CHARS, WORDS = 0, 1


def within(a: Column, b: Column, distance: int = DISTANCE) -> Column:
    """Whether two strings, whose lengths differ by ``distance`` at most, are within that many edits.

    ``p`` and ``t`` hold their characters. Column by column over ``t``; the bits are the cells of a band of twice the
    distance plus one around the diagonal.
    """
    k, band = distance, 2 * distance + 1
    full, top = (1 << band) - 1, 1 << (band - 1)
    n = F.size("p")
    inv = lambda x: x.bitwiseXOR(F.lit(full))
    let = lambda value, then: F.transform(F.array(value), then)[0]
    num = lambda x: F.lit(x).cast("long")

    def step(acc: Column, i: Column) -> Column:
        same = sum(
            (F.when(F.get(F.col("p"), i - k + d).eqNullSafe(F.get(F.col("t"), i)), num(1 << d)).otherwise(num(0)) for d in range(band)),
            num(0),
        )
        vp, vn = acc["vp"], acc["vn"]

        def rest(d0: Column) -> Column:
            hp = vn.bitwiseOR(inv(d0.bitwiseOR(vp)))
            hn = d0.bitwiseAND(vp)
            down = F.shiftright(d0, 1)
            diagonal = F.when(d0.bitwiseAND(top) == 0, 1).otherwise(0)
            flat = F.when(hp.bitwiseAND(acc["mask"]) != 0, 1).otherwise(0) - F.when(hn.bitwiseAND(acc["mask"]) != 0, 1).otherwise(0)
            inside = i < n - k
            return F.struct(
                hn.bitwiseOR(inv(down.bitwiseOR(hp))).bitwiseAND(F.lit(full)).alias("vp"),
                down.bitwiseAND(hp).alias("vn"),
                F.when(inside, acc["mask"]).otherwise(F.shiftright(acc["mask"], 1)).alias("mask"),
                (acc["edits"] + F.when(inside, diagonal).otherwise(flat)).alias("edits"),
            )

        carried = lambda x: (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(F.lit(full))
        return let(same, lambda x: let(carried(x), rest))

    start = F.struct(
        num(((1 << (k + 1)) - 1) << k).alias("vp"), num(0).alias("vn"), num(top >> 1).alias("mask"), F.lit(k).alias("edits")
    )
    walked = F.aggregate(F.sequence(F.lit(0), F.size("t") - 1), start, step, lambda acc: acc["edits"] <= k)
    # fewer characters than edits leave no band to walk
    return F.when((F.size("p") < k) | (F.size("t") < 1), F.levenshtein(a, b) <= k).otherwise(walked)


#: A pair is looked at where lines are cut into so many parts before it is verified.
CUTS = 8


def may_be_near(a: Column, b: Column) -> Column:
    """False only for pairs more than one edit apart: the edit lies on one side of any cut, so the other sides are equal."""
    n, m = F.length(a), F.length(b)
    conditions = []
    for i in range(1, CUTS):
        cut = F.floor(n * i / CUTS).cast("int")
        left = F.substring(a, F.lit(1), cut) == F.substring(b, F.lit(1), cut)
        right = F.substring(a, cut + 1, n - cut) == F.substring(b, m - n + cut + 1, n - cut)
        conditions.append(left | right)
    return reduce(lambda x, y: x & y, conditions)


def _shared(a: Column, b: Column, most: Column, part) -> Column:
    """The longest length up to ``most`` whose ``part`` (prefix or suffix) both lines share, by halving the step."""
    steps = F.filter(F.array(*(F.lit(1 << i) for i in range(30, -1, -1))), lambda s: s <= most)

    def longer(got: Column, step: Column) -> Column:
        length = got + step
        return F.when((length <= most) & (part(a, length) == part(b, length)), length).otherwise(got)

    return F.aggregate(steps, F.lit(0), longer)


def verified(pairs: DataFrame) -> DataFrame:
    """The pairs ``(a, b, a_text, b_text)`` that are within the distance, as ``(a, b)``.

    What both lines begin and end with does not count towards their distance
    and is cut off before the bits are walked. The one-element explodes keep
    the optimizer from copying each step into the next.
    """
    once = lambda value, name: F.explode(F.array(value)).alias(name)
    a, b = F.col("a_text"), F.col("b_text")
    head = lambda x, n: F.substring(x, F.lit(1), n)
    tail = lambda x, n: F.substring(x, F.length(x) - n + 1, n)
    shorter = F.least(F.length(a), F.length(b))
    near = pairs.where(may_be_near(a, b)).select("a", "b", "a_text", "b_text", once(_shared(a, b, shorter, head), "head"))
    rest = lambda x, name: F.substring(x, F.col("head") + 1, F.length(x)).alias(name)
    near = near.select("a", "b", once(F.struct(rest(a, "a_text"), rest(b, "b_text")), "_r")).select("a", "b", "_r.*")
    near = near.select("a", "b", "a_text", "b_text", once(_shared(a, b, shorter, tail), "tail"))
    core = lambda x, name: F.substring(x, F.lit(1), F.length(x) - F.col("tail")).alias(name)
    near = near.select("a", "b", once(F.struct(core(a, "a_text"), core(b, "b_text")), "_r")).select("a", "b", "_r.*")
    chars = near.select("a", "b", "a_text", "b_text", once(F.struct(characters(a).alias("p"), characters(b).alias("t")), "_r"))
    return chars.select("a", "b", "a_text", "b_text", "_r.*").where(within(a, b)).select("a", "b")


def verified_words(pairs: DataFrame) -> DataFrame:
    """The pairs ``(a, b, a_text, b_text)`` whose words are within one edit: all but one are in what they begin and end with."""
    rows = pairs.select("a", "b", F.explode(F.array(F.struct(words(F.col("a_text")).alias("p"), words(F.col("b_text")).alias("t")))).alias("_r"))
    rows = rows.select("a", "b", "_r.*")
    shorter, longer = F.least(F.size("p"), F.size("t")), F.greatest(F.size("p"), F.size("t"))
    places = F.sequence(F.lit(0), shorter - 1)

    def same(at) -> Column:
        differs = F.filter(places, lambda i: F.get("p", at(i, F.size("p"))) != F.get("t", at(i, F.size("t"))))
        return F.coalesce(F.get(differs, 0), shorter)

    shared = same(lambda i, n: i) + same(lambda i, n: n - 1 - i)
    return rows.where((longer - shorter <= 1) & (shared >= longer - 1)).select("a", "b")


def _entries(n: Column, unit: int, first: Column, last: Column, other: Column) -> list[Column]:
    """What a line of ``n`` places is entered under: its length and all outside one half, for both halves; then what it probes.

    ``first`` and ``last`` are hashes of the half it begins and ends with, without the middle place of an odd line;
    ``other`` is that of the end with this place, or of the begin less one place if there is none.
    """
    odd = n % 2 == 1
    key = lambda half, length, rest: F.xxhash64(F.lit(2 * unit + half), length, rest)
    own = key(0, n, F.when(odd, other).otherwise(last)), key(1, n, first)
    return [*own, key(0, n - 1, last), key(1, n - 1, F.when(odd, first).otherwise(other))]


def _halves(n: Column, text: str, head: Column, middle: Column, gap: int) -> list[Column]:
    """Hashes of ``first``, ``last`` and ``other`` of a line of ``n`` places, cut by bytes without a walk over it.

    ``head`` bytes are its first half, rounded down; ``middle`` those of the place after it, in an even line of the last one
    in it. Between places are ``gap`` bytes.
    """
    line, size, odd = F.col(text).cast("binary"), F.octet_length(text), n % 2 == 1
    gaps = F.when(head > 0, gap).otherwise(0)
    after = lambda at: F.substring(line, at + gaps + 1, size)
    first, last = F.substring(line, F.lit(1), head), after(F.when(odd, head + middle + gaps).otherwise(head))
    other = F.when(odd, after(head)).otherwise(F.substring(line, F.lit(1), head - middle - gap))
    return [F.xxhash64(part) for part in (first, last, other)]


def _outside(line: Column, length: Column, lo: Column, hi: Column, unit: int, seed: int = 0) -> Column:
    size, part = UNITS[unit]
    tail = length - hi
    return F.xxhash64(F.lit(2 * seed + unit), length, lo, hi, part(line, F.lit(1), lo), part(line, size(line) - tail + 1, tail))


def _used(line: Column, shortest: int) -> Column:
    # a character has four bytes at most: only short lines are counted
    near = (F.octet_length(line) >= 4 * MIN_CHARS) | (F.length(line) >= MIN_CHARS)
    return near | ((F.length(line) >= shortest) & (F.trim(line, F.lit(BLANKS)) != "")) if shortest < MIN_CHARS else near


def _split(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def every_line(docs: DataFrame, text: str, *columns: str, shortest: int = MIN_CHARS) -> DataFrame:
    """``(*columns, line)`` for the lines of each document of ``shortest`` characters that are not blank."""
    rows = docs.select(*columns, F.explode(_split(text)).alias("_raw"))
    # a one-element explode: else the optimizer lowers each line twice, once for the filter
    rows = rows.select(*columns, F.explode(F.array(normal(F.col("_raw")))).alias("line"))
    return rows.where(_used(F.col("line"), shortest))


def occurrences(docs: DataFrame, key: str, text: str, shortest: int = MIN_CHARS) -> DataFrame:
    """``(doc, version, h, at, again)`` for the lines of each document of ``shortest`` characters that are not blank.

    ``version`` tells texts under one id apart, ``h`` stands for the line, ``again`` marks its later occurrences in the
    document.
    """
    entry = lambda line, i: F.when(_used(line, shortest), F.struct(_hash(line).alias("h"), i.alias("at")))
    rows = docs.select(F.col(key).alias("doc"), text_version(F.col(text)).alias("version"), F.transform(_split(text), normal).alias("lines"))
    rows = rows.select("doc", "version", F.sort_array(F.array_compact(F.transform("lines", entry))).alias("lines"))
    again = F.transform("lines", lambda x, i: F.struct(x.alias("of"), F.coalesce(F.get(F.col("lines"), i - 1)["h"] == x["h"], F.lit(False)).alias("again")))
    return rows.select("doc", "version", F.inline(again)).select("doc", "version", "of.*", "again")


def _hash(line: Column) -> Column:
    """128 bits for a line: two hashes with different seeds."""
    return F.struct(F.xxhash64(line).alias("x"), F.xxhash64(F.lit(1), line).alias("y"))


def distinct_lines(docs: DataFrame, key: str, text: str, long_words: int = LONG_WORDS, shortest: int = MIN_CHARS) -> DataFrame:
    """``(h, first_doc, n, k0..k3, w0..w3)``: each different line, the first document with it and how often it occurs.

    ``k0`` to ``k3`` are its segment entries, null in lines under ``MIN_CHARS``, and ``w0`` to ``w3`` those by words, null in
    lines of fewer than ``long_words``.
    """
    line, chars, count = F.col("line"), F.col("chars"), F.col("count")
    found = every_line(docs.withColumn("doc", F.col(key)), text, "doc", shortest=shortest).select("doc", "line", F.length("line").alias("chars"))
    found = found.select("*", F.when(chars >= MIN_CHARS, F.split("line", " ")).alias("pieces"))
    found = found.select("*", F.array_remove("pieces", "").alias("array"))
    single = F.when(F.size("pieces") == F.size("array"), line).otherwise(F.array_join("array", " "))
    found = found.select("doc", "line", "chars", "array", F.size("array").alias("count"), single.alias("single"))
    # where each character is a byte none is looked for
    plain = F.octet_length("line") == chars
    letters = lambda start, size: F.when(plain, size).otherwise(F.octet_length(F.substring(line, start, size)))
    half, middle = (lambda n: F.shiftright(n, 1)), lambda n: F.shiftright(n, 1) + n % 2
    sizes = {
        "k_head": F.when(chars >= MIN_CHARS, letters(F.lit(1), half(chars))),
        "k_middle": letters(middle(chars), F.lit(1)),
        "w_head": F.when(count >= long_words, F.octet_length(F.call_function("substring_index", F.col("single"), F.lit(" "), half(count)))),
        "w_middle": F.octet_length(F.get("array", middle(count) - 1)),
    }
    found = found.select("doc", "line", "chars", "count", "single", *(size.alias(name) for name, size in sizes.items()))
    units = (CHARS, "k", "chars", "line"), (WORDS, "w", "count", "single")
    names = "first", "last", "other"
    parts = [
        F.when(F.col(f"{name}_head").isNotNull(), part).alias(f"{name}_{at}")
        for unit, name, n, whole in units
        for at, part in zip(names, _halves(F.col(n), whole, F.col(f"{name}_head"), F.col(f"{name}_middle"), unit), strict=True)
    ]
    found = found.select("doc", _hash(line).alias("h"), "chars", "count", *parts)
    entries = {}
    for unit, name, n, _ in units:
        every = _entries(F.col(n), unit, *(F.col(f"{name}_{part}") for part in names))
        entries |= {f"{name}{j}": F.when(F.col(f"{name}_first").isNotNull(), entry) for j, entry in enumerate(every)}
    found = found.select("doc", "h", *(entry.alias(name) for name, entry in entries.items()))
    facts = [F.min("doc").alias("first_doc"), F.count("*").alias("n"), *(F.first(k).alias(k) for k in entries)]
    return found.groupBy("h.x", "h.y").agg(*facts).select(F.struct("x", "y").alias("h"), "first_doc", "n", *entries)


def _meetings(entries: DataFrame, crowded: int, *carried: str) -> tuple[DataFrame, DataFrame]:
    """Splits ``(key, role, node, ...)`` into rows of keys where a pair can meet and few do, and rows of crowded keys."""
    # all are counted in the lower half of one number, those of role 0 in its upper half
    counts = entries.groupBy("key").agg(F.sum(F.when(F.col("role") == 0, F.lit((1 << 32) + 1)).otherwise(F.lit(1))).alias("counts"))
    n, own = F.col("counts").bitwiseAND((1 << 32) - 1), F.shiftright("counts", 32)
    shared = saved(counts.where((n > 1) & (own > 0)).select("key", (n > crowded).alias("many")))
    likely, _ = maybe_in(entries, shared, "key")
    met = saved(salted_join(likely, shared, "key", F.col("node")).select("key", "role", "node", *carried, "many"))
    return met.where("not many").drop("many"), met.where("many").drop("many")


def _pairs(few: DataFrame, *carried: str) -> DataFrame:
    """Pairs ``(a, b)`` of a line that is indexed and one that is of its length or probes it."""
    a = few.where("role = 0").select("key", F.col("node").alias("a"), *(F.col(c).alias(f"a_{c}") for c in carried))
    b = few.select(F.col("key").alias("other"), "role", F.col("node").alias("b"), *(F.col(c).alias(f"b_{c}") for c in carried))
    return a.join(b, (F.col("key") == F.col("other")) & ((F.col("role") == 1) | (F.col("a") < F.col("b")))).drop("key", "other", "role")


def near_lines(docs: DataFrame, lines: DataFrame, text: str, crowded: int = CROWDED) -> DataFrame:
    """Links ``(a, b)`` between different lines whose components are those of one edit of characters or words.

    Outside crowds these are all links.
    """

    def entry(unit: int, j: int) -> Column:
        key = F.col(f"{'kw'[unit]}{j}").alias("key")
        return F.struct(key, F.lit(j // 2).alias("role"), F.lit(j % 2).alias("half"), F.lit(unit).alias("unit"))

    entries = lines.select(F.col("h").alias("node"), F.inline(F.array(*(entry(unit, j) for unit in (CHARS, WORDS) for j in range(4)))))
    few, many = _meetings(entries.where("key is not null"), crowded, "half", "unit")
    pairs = saved(_pairs(few, "unit").select("a", "b", F.col("a_unit").alias("unit")).distinct())
    many = many.select("node", "role", "half", "unit")
    wanted = saved(pairs.select(F.col("a").alias("h")).union(pairs.select("b")).union(many.select("node")).distinct())
    texts = saved(_texts(docs, wanted, text))
    a, b = (texts.select(F.col("h").alias(f"{s}_h"), F.col("text").alias(f"{s}_text")) for s in "ab")
    links = []
    for unit, judged in ((CHARS, verified), (WORDS, verified_words)):
        met = pairs.where(F.col("unit") == unit).join(a, F.col("a") == F.col("a_h")).join(b, F.col("b") == F.col("b_h"))
        links.append(judged(met))
    length = F.when(F.col("unit") == CHARS, F.length("text")).otherwise(F.size(words(F.col("text")))) - F.col("role")
    crowd = many.join(texts, F.col("node") == F.col("h")).withColumn("_length", length)
    middle = F.floor(F.col("_length") / 2).cast("int")
    lo = F.when(F.col("half") == 0, 0).otherwise(middle)
    hi = F.when(F.col("half") == 0, middle).otherwise(F.col("_length"))
    links.append(_crowd_links(saved(crowd.select("node", "unit", "role", lo.alias("lo"), hi.alias("hi"))), texts))
    return reduce(DataFrame.union, links).distinct()


#: Into how many parts the rest of a crowded line is cut in each round.
PARTS = 8


def _crowd_links(crowd: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that hold together what crowded lines ``(node, unit, role, lo, hi)`` are within one edit of, the edit within lo and hi.

    Rounds move hashes and bounds; texts ``(h, text)`` are only joined to make them.
    """
    last = []
    while crowd.take(1):
        entries = _cut(crowd, texts)
        own = F.count(F.when(F.col("role") == 0, 1))
        shared = entries.groupBy("key").agg(F.count("*").alias("n"), own.alias("own")).where("n > 1 and own > 0")
        shared = saved(shared.select(F.col("key").alias("met"), F.lit(True).alias("there")))
        likely, _ = maybe_in(entries, shared.withColumnRenamed("met", "key"), "key")
        met = saved(salted_join(likely, shared.withColumnRenamed("met", "key"), "key", F.col("node")).drop("there"))
        last.append(met.where("hi - lo = 1").select("node", "role", "key", "sure", "one", "two"))
        crowd = met.where("hi - lo > 1").select("node", "unit", "role", "lo", "hi")
    if not last:
        return texts.where("false").select(F.col("h").alias("a"), F.col("h").alias("b"))
    ended = saved(reduce(DataFrame.union, last).select("node", "role", F.struct("key", "sure").alias("key"), "one", "two"))
    # lines of one length that agree in all but one place are within one edit of each other
    same = ended.where("role = 0").select("key", F.col("node").alias("b"))
    least = same.groupBy("key").agg(F.min("b").alias("a"))
    stars = salted_join(same, least, "key", F.col("b")).where("a <> b").select("a", "b")
    # a line one longer has one thing more there than the others: without either of its two it may be one of them
    longer = ended.where("role = 1").select(F.col("node").alias("b"), F.explode(F.array("one", "two")).alias("left"), "key")
    longer = longer.select("b", F.struct("key", "left").alias("key"))
    # lines that differ in blanks only have equal words: one stands for all, which the stars hold together
    single = ended.where("role = 0").groupBy(F.struct("key", F.col("one").alias("left")).alias("key")).agg(F.min("node").alias("a"))
    return stars.union(salted_join(longer, single, "key", F.col("b")).select("a", "b"))


def _cut(crowd: DataFrame, texts: DataFrame) -> DataFrame:
    """``(node, unit, role, lo, hi, key, sure, one, two)``: the rests of lines cut into parts, each with what lies outside it.

    Where a part is a single place ``sure`` is a second hash, and ``one`` and ``two`` stand for what is there.
    """
    # each line has one text and no more rows than places
    rows = crowd.join(texts, F.col("node") == F.col("h"))
    size = F.col("hi") - F.col("lo")
    step = F.greatest(F.ceil(size / PARTS).cast("int"), F.lit(1))
    starts = F.when(size > 0, F.sequence(F.col("lo"), F.col("hi") - 1, step)).otherwise(F.array().cast("array<int>"))
    found = []
    for unit in (CHARS, WORDS):
        measure, part = UNITS[unit]
        line = F.col("line")
        length = measure(line) - F.col("role")

        def entry(lo: Column) -> Column:
            hi = F.least(lo + F.col("step"), F.col("hi"))
            single = hi - lo == 1
            at = lambda i: F.xxhash64(part(line, lo + i, F.lit(1)))  # noqa: B023, E731
            return F.struct(
                lo.alias("lo"), hi.alias("hi"), _outside(line, length, lo, hi, unit).alias("key"),  # noqa: B023
                F.when(single, _outside(line, length, lo, hi, unit, 1)).alias("sure"),  # noqa: B023
                F.when(single, at(1)).alias("one"), F.when(single & (F.col("role") == 1), at(2)).alias("two"),
            )

        some = rows.where(F.col("unit") == unit).withColumn("line", words(F.col("text")) if unit == WORDS else F.col("text"))
        some = some.select("node", "unit", "role", "hi", "line", step.alias("step"), starts.alias("starts"))
        found.append(some.select("node", "unit", "role", F.inline(F.transform("starts", entry))))
    return found[0].union(found[1])


def _texts(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """``(h, text)`` of the wanted lines; a sketch of them keeps other lines from being moved."""
    lines = every_line(docs, text).select(_hash(F.col("line")).alias("h"), F.col("line").alias("text"))
    likely, _ = maybe_in(lines, wanted, "h")
    # partial aggregates make one of many equal lines before they are moved; they sort by numbers faster than by structs
    texts = likely.groupBy("h.x", "h.y").agg(F.first("text").alias("text"))
    keys = wanted.select(F.col("h.x").alias("_x"), F.col("h.y").alias("_y"))
    return texts.join(keys, (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y")), "left_semi").select(F.struct("x", "y").alias("h"), "text")


def repeated_lines(
    docs: DataFrame, key: str, text: str, crowded: int = CROWDED, long_words: int = LONG_WORDS, shortest: int = MIN_CHARS
) -> DataFrame:
    """``(h, keeper, gone)``: lines that occur several times or have near-equal ones, and the document that keeps them.

    A line that gives way to a near-equal one of its own first document has no
    keeper and ``gone`` set.
    """
    lines = saved(distinct_lines(docs, key, text, long_words, shortest))
    found = saved(components(near_lines(docs, lines, text, crowded)))
    linked = lines.select("h", "first_doc").join(found, F.col("h") == F.col("node")).select("h", "first_doc", "root")
    best = linked.groupBy("root").agg(F.min(F.struct(F.col("first_doc").isNull().alias("none"), F.col("first_doc").alias("doc"), F.col("h").alias("line"))).alias("best"))
    linked = saved(salted_join(linked, saved(best), "root", F.col("h")))
    linked = linked.select("h", F.col("best.doc").alias("keeper"), (F.col("h") != F.col("best.line")).alias("gone"))
    alone = lines.where("n > 1").join(linked.select("h"), "h", "left_anti")
    return linked.union(alone.select("h", F.col("first_doc").alias("keeper"), F.lit(False).alias("gone")))


def dropped_lines(
    docs: DataFrame, key: str, text: str, crowded: int = CROWDED, long_words: int = LONG_WORDS, shortest: int = MIN_CHARS
) -> DataFrame:
    """``(doc, version, drops)``: the places of the lines that go, for documents that lose any."""
    repeated = saved(repeated_lines(docs, key, text, crowded, long_words, shortest))
    places = occurrences(docs, key, text, shortest)
    likely, _ = maybe_in(places, repeated, "h")
    # joined by half the hash, as numbers sort faster than structs; later occurrences in a document are repeated ones too
    facts = repeated.select(F.col("h.x").alias("half"), F.col("h").alias("line"), "keeper", "gone")
    met = salted_join(likely.withColumn("half", F.col("h.x")), facts, "half", F.struct("doc", "at")).where("h = line")
    elsewhere = F.col("gone") | ~F.col("doc").eqNullSafe(F.col("keeper"))
    drops = met.where(F.col("again") | elsewhere).select("doc", "version", "at")
    return drops.groupBy("doc", "version").agg(F.collect_set("at").alias("drops"))


def dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", crowded: int = CROWDED, long_words: int = LONG_WORDS, shortest: int = MIN_CHARS
) -> DataFrame:
    """``docs`` with repeated and near-repeated lines removed from ``text``, and the columns ``n_lines`` and ``n_dropped``.

    A line stays in the document of smallest id that has it, once; of lines
    within one edit one stays, where lines of ``long_words`` words or more may
    differ in a word. Equal lines are found from ``shortest`` characters on
    unless they are blank (1: all lines), near ones from ``MIN_CHARS`` on. Null
    texts stay null and have no lines; empty texts have one empty line; a text may
    become empty. Documents with a null id come last. Rows that repeat an id
    are one document and keep the same lines; a repeated line within a row goes.
    Columns of ``docs`` named n_lines or n_dropped are replaced. An empty table
    gives an empty result.
    """
    drops = saved(dropped_lines(docs, key, text, crowded, long_words, shortest))
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*own).alias("row"), F.col(key).alias("doc"), text_version(F.col(text)).alias("version"))
    some, none = maybe_in(rows, drops, "doc", "version")
    facts = drops.select(F.col("doc").alias("d"), F.col("version").alias("v"), "drops")
    some = some.join(facts, F.col("doc").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")), "left").select("row", "drops")
    none = none.select("row", F.lit(None).cast("array<int>").alias("drops"))
    return _rewritten(some, own, text).union(_rewritten(none, own, text))


def _rewritten(rows: DataFrame, own: list[str], text: str) -> DataFrame:
    lines = F.split(F.col("row")[text], "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("drops"))
    rows = rows.withColumn("_lines", F.when(F.col("drops").isNotNull(), lines)).withColumn("_kept", kept)
    short = F.array_join(F.transform("_kept", lambda i: F.get(F.col("_lines"), i)), "\n")
    body = F.when(F.col("drops").isNull(), F.col("row")[text]).otherwise(short)
    return rows.select(
        *(body.alias(c) if c == text else F.col("row")[c].alias(c) for c in own),
        F.when(F.col("row")[text].isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
    )
