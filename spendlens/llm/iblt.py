"""Document fingerprints as invertible Bloom lookup sketches.  DataFrame functions only.

A text's *paragraphs* (sentences, and pieces of long runs without an end of sentence;
blank ones do not count) are hashed to 64-bit digests, so that an edit changes few of
them, even in a text of one line.  Each digest of the set is added to three cells of a
sketch, one in each third: a cell holds how many digests it got, their exclusive-or,
and the exclusive-or of their check hashes.  Subtracting two sketches cell by cell
cancels what the versions share; *peeling* then recovers the digests that differ, from
cells that hold a single one.

A text's fingerprint is its sketch of ``CELLS`` cells, written out; two stored
fingerprints can be subtracted.  A sketch of few cells can only yield few differences.
If peeling stalls, both sides are sketched again, as large as the difference that the
sets' smallest digests let expect asks for, then twice and four times as large.

Cells are kept as the array of those that are not empty, in order of place.  Entries
are gathered into cells by sorting them, so that all steps take n log n, and a text of
many paragraphs costs in proportion to its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.llm.common import let, materialise, shuffle_width, unused

#: Cells of a text's fingerprint, a multiple of three.
CELLS = 12
#: Cells for each difference that is to be expected, retry by retry, and the fewest.
RETRIES, FEWEST = (2, 4, 8), 24
#: Digests of each set, the smallest, by which the size of a difference is foreseen.
SAMPLE = 16
ROUNDS = 60  # of peeling, at most; a stall ends it

CELL = "array<struct<p:int,n:int,id:bigint,ck:bigint>>"
ENTRY = "array<struct<id:bigint,sign:int>>"
STATE = f"struct<cells:{CELL},now:{ENTRY},out:{ENTRY}>"
#: Characters, two of which in a row are rare enough to cut long runs at, in ASCII and in
#: other scripts, and such as end words: where they stand depends on the text alone.
_ASCII = "gkqwyzGKQWYZ0479/+="
_LAST = _ASCII + "dfmrt"
_OTHER = (r"\u0431-\u0435\u043c\u043d\u05d0-\u05d4\u0627-\u062b\u0915-\u091b\u0e01-\u0e0a"
          r"\u3044-\u304b\u30a4-\u30ab\u4e00-\u50ff\u5f00-\u61ff\u7000-\u72ff\u8100-\u83ff"
          r"\uac00-\uaeff\ub800-\ubaff\uc400-\uc6ff\ud000-\ud2ff")
_QUOTES = "[\"')\\]\u201d\u2019]"
#: Pieces of up to so many code points are not cut further.
RUN = 120
#: A line's end; a blank after an end of sentence; after a full stop of scripts without blanks.
PARAGRAPH_END = rf"\n| (?:(?<=[.!?] )|(?<=[.!?]{_QUOTES} ))|(?<=[。！？])"
#: The same where a line's end stands after each of those full stops: it looks behind at blanks only.
_END = rf"[\n ](?:(?<=\n)|(?<=[.!?] )|(?<=[.!?]{_QUOTES} ))"
#: Beyond ``RUN``: a blank after one of the characters above, or two of them.
RUN_END = (rf" (?<=[{_LAST}] )|(?<=[{_ASCII}]{{2}})"
           rf"|(?<=[\u0400-\uffff])(?<=[{_OTHER}]{{2}})")
#: What is longer even so (uniform text) is cut every so many code points.
LONGEST = 8192


def digests(text: Column) -> Column:
    """Distinct paragraph digests; blank paragraphs do not count; null: none."""
    def long_run(p: Column) -> Column:
        """Cut at the first places beyond ``RUN`` code points that allow it."""
        start, rest = F.substr(p, F.lit(1), F.lit(RUN)), F.substr(p, F.lit(RUN + 1), F.char_length(p))
        parts = let(F.split(rest, RUN_END), "array<string>", lambda x: F.concat(
            F.array(F.concat(start, F.get(x, F.lit(0)))), F.slice(x, 2, F.size(x))))
        return F.flatten(F.transform(parts, lambda q: F.when(
            F.char_length(q) <= LONGEST, F.array(q)).otherwise(
            F.regexp_extract_all(q, F.lit(f"(?s).{{1,{LONGEST}}}"), F.lit(0)))))

    lines = F.coalesce(text, F.lit(""))
    for stop in "。！？":
        lines = F.replace(lines, F.lit(stop), F.lit(stop + "\n"))
    parts = F.split(lines, _END)
    hashes = F.transform(parts, lambda p: F.when(F.char_length(p) <= RUN, F.array(p))
                         .otherwise(long_run(p)))
    said = F.filter(F.flatten(hashes), lambda p: F.trim(p) != "")
    return F.array_distinct(F.transform(said, lambda p: F.xxhash64(p)))


def _check(d: Column) -> Column:
    return F.xxhash64(F.lit(-1), d)


def _entries(found: Column, cells: Column) -> Column:
    """Three entries for each (id, sign), one in each third of the cells."""
    third = F.floor(cells / 3).cast("int")
    return F.flatten(F.transform(found, lambda e: F.array(*[F.struct(
        (F.pmod(F.xxhash64(F.lit(t), e["id"]), third).cast("int") + third * t).alias("p"),
        e["sign"].alias("n"), e["id"].alias("id"), _check(e["id"]).alias("ck")) for t in range(3)])))


def _gathered(entries: Column) -> Column:
    """Entries and cells, any number for a place, as cells in order of place: counts added,
    exclusive-ors combined, empty cells left out.

    What is sorted are numbers, place and index in one, and not the entries."""
    zero, low = F.lit(0).cast("bigint"), F.lit((1 << 32) - 1)
    start = F.struct(F.lit(0).alias("n"), zero.alias("id"), zero.alias("ck"))

    def runs(x: Column, s: Column) -> Column:
        def item(key: Column) -> Column:
            return F.get(x, key.bitwiseAND(low).cast("int"))

        def place(i: Column) -> Column:
            return F.shiftright(F.get(s, i), 32)

        def summed(i: Column, end: Column) -> Column:
            return F.aggregate(
                F.slice(s, i + 1, end - i), start,
                lambda a, k: let(item(k), "struct<n:int,id:bigint,ck:bigint>", lambda e: F.struct(
                    (a["n"] + e["n"]).alias("n"), a["id"].bitwiseXOR(e["id"]).alias("id"),
                    a["ck"].bitwiseXOR(e["ck"]).alias("ck"))),
                lambda a: F.struct(place(i).cast("int").alias("p"), a["n"].alias("n"), a["id"].alias("id"),
                                   a["ck"].alias("ck")))

        firsts = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                          lambda i: (i == 0) | (place(i) != place(i - 1)))
        return let(firsts, CELL, lambda f: F.filter(F.transform(f, lambda i, k: F.when(
            F.coalesce(F.get(f, k + 1), F.size(s)) == i + 1, item(F.get(s, i))).otherwise(
            summed(i, F.coalesce(F.get(f, k + 1), F.size(s))))),
            lambda c: (c["n"] != 0) | (c["id"] != 0) | (c["ck"] != 0)))

    return let(entries, CELL, lambda x: let(F.sort_array(F.transform(x, lambda e, i: F.shiftleft(
        e["p"].cast("bigint"), 32) + i)), CELL, lambda s: F.when(F.size(s) > 0, runs(x, s)).otherwise(
            F.array().cast(CELL))))


def _signed(ids: Column, sign: int) -> Column:
    return F.transform(ids, lambda d: F.struct(d.alias("id"), F.lit(sign).alias("sign")))


def sketch(items: Column, cells) -> Column:
    """The sketch of a digest set: its cells (p, n, id, ck) that are not empty.  ``cells``: a
    number or a column, at least three; of ``3 k + 1`` and ``3 k + 2`` only ``3 k`` are used."""
    return _gathered(_entries(_signed(items, 1), cells if isinstance(cells, Column) else F.lit(cells)))


def subtract(a: Column, b: Column) -> Column:
    """Cell by cell: counts subtract, exclusive-ors cancel."""
    return _gathered(F.concat(a, F.transform(b, lambda c: F.struct(
        c["p"].alias("p"), (-c["n"]).alias("n"), c["id"].alias("id"), c["ck"].alias("ck")))))


def peel(cells_diff: Column, cells) -> Column:
    """The digests of a sketch difference as an array of (id, sign), sign 1 for the
    first set's; null if it can't be peeled."""
    cells = cells if isinstance(cells, Column) else F.lit(cells)

    def pure(left: Column) -> Column:
        single = F.filter(left, lambda c: (F.abs(c["n"]) == 1) & (_check(c["id"]) == c["ck"]))
        # one of each, from its neighbours: array_distinct compares all pairs of structs
        return let(F.sort_array(F.transform(single, lambda c: F.struct(
            c["id"].alias("id"), c["n"].alias("sign")))), ENTRY, lambda s: F.filter(
                s, lambda e, i: (i == 0) | (F.get(s, i - 1)["id"] != e["id"])))

    def state(left: Column, out: Column) -> Column:
        return let(left, STATE, lambda c: F.struct(
            c.alias("cells"), pure(c).alias("now"), out.alias("out")))

    def step(acc: Column, _: Column) -> Column:
        gone = F.transform(acc["now"], lambda e: F.struct(e["id"].alias("id"), (-e["sign"]).alias("sign")))
        return F.when(F.size(acc["now"]) == 0, acc).otherwise(
            state(_gathered(F.concat(acc["cells"], _entries(gone, cells))),
                  F.concat(acc["out"], acc["now"])))

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), state(cells_diff, F.array().cast(ENTRY)), step,
        lambda s: F.when(F.size(s["cells"]) == 0, s["out"]))


def expected_difference(a: Column, b: Column) -> Column:
    """About how many digests stand in one set only: from the share of the two sets' smallest
    ``SAMPLE`` digests together that both have.  A guess; a retry mends a low one."""
    def least(x: Column) -> Column:
        return F.slice(F.sort_array(x), 1, SAMPLE)

    kind = "array<bigint>"
    union = let(least(F.array_union(least(a), least(b))), kind, lambda u: u)
    both = F.size(F.array_intersect(F.array_intersect(union, least(a)), least(b)))
    share = both / F.greatest(F.size(union), F.lit(1))
    return (F.size(a) + F.size(b)) * (1 - share) / (1 + share)


def difference(a: Column, b: Column, small_a: Column | None = None, small_b: Column | None = None,
               cells: int = CELLS, retries: tuple[int, ...] = RETRIES) -> Column:
    """Digests in one set only, as (id, sign); sign 1: in ``a`` only.

    First the sets' fixed sketches of ``cells`` cells (given, if they are there already);
    if their difference can't be peeled, sketches of the expected size of the difference
    times each of ``retries``, and at last of as many cells for all digests of both.
    Sets that none can peel are compared as sets (about never)."""
    small_a = sketch(a, cells) if small_a is None else small_a
    small_b = sketch(b, cells) if small_b is None else small_b
    all_of = (F.size(a) + F.size(b)).cast("double")

    def tried(size: Column) -> Column:
        return let(F.greatest(size.cast("int"), F.lit(FEWEST)), "struct<found:" + ENTRY + ">",
                   lambda n: F.struct(peel(_gathered(F.concat(
                       _entries(_signed(a, 1), n), _entries(_signed(b, -1), n))), n).alias("found")))["found"]

    guess = expected_difference(a, b)
    sizes = [F.least(guess, all_of) * r for r in retries] + [all_of * max(retries)]
    sets = F.concat(_signed(F.array_except(a, b), 1), _signed(F.array_except(b, a), -1))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.array().cast(ENTRY)).otherwise(
        F.coalesce(peel(subtract(small_a, small_b), cells), *map(tried, sizes), sets))


def likeness(n_a: Column, n_b: Column, diff: Column) -> Column:
    """Shared digests over all digests of both sets, from the sets' sizes and their
    recovered difference; two empty sets are alike."""
    only_a = F.size(F.filter(diff, lambda e: e["sign"] == 1))
    only_b = F.size(diff) - only_a
    union = n_a + only_b
    return F.when(union == 0, F.lit(1.0)).otherwise((n_a - only_a) / union).cast("double")


def fingerprint(cells: Column) -> Column:
    """A sketch as text: ``place:count:digests:checks`` of its cells, comma-joined."""
    return F.concat_ws(",", F.transform(cells, lambda c: F.concat_ws(
        ":", *[c[k].cast("string") for k in ("p", "n", "id", "ck")])))


def cells_of(written: Column) -> Column:
    """The sketch that a fingerprint is the text of."""
    parts = F.filter(F.split(written, ","), lambda c: c != "")
    return F.transform(F.transform(parts, lambda c: F.split(c, ":")), lambda v: F.struct(*[
        F.get(v, F.lit(i)).cast(kind).alias(k) for i, (k, kind) in enumerate(
            (("p", "int"), ("n", "int"), ("id", "bigint"), ("ck", "bigint")))]))


def compare_texts(rows: DataFrame, old: str, new: str) -> DataFrame:
    """``rows`` with ``removed`` and ``added`` (digests of paragraphs in one text only) and
    ``likeness``, in place of columns of these names; null texts count as empty; all other
    columns stay."""
    a, b, d = unused(rows, "a", "b", "d")
    return (rows.withColumns({a: digests(F.col(old)), b: digests(F.col(new))})
            .withColumn(d, difference(F.col(a), F.col(b)))
            .withColumns({
                "removed": F.transform(F.filter(d, lambda e: e["sign"] == 1), lambda e: e["id"]),
                "added": F.transform(F.filter(d, lambda e: e["sign"] == -1), lambda e: e["id"]),
                "likeness": likeness(F.size(a), F.size(b), F.col(d))})
            .drop(a, b, d))


def with_next(docs: DataFrame, id_col: str, text_col: str, rows_in_range: int = 2000,
              cuts: int = 64, carry=lambda text: text) -> DataFrame:
    """Adds ``next``: the text of the next row in ascending order of id (nulls first, ties by
    text), after the last that of the first.  ``carry``: what of a text is to travel, ordered
    as the texts are; it stands in place of the text and in ``next``, and is worked out once.

    Rows are dealt into ranges of ids: between ``cuts`` quantiles, equal steps.  A range
    is one window; its last row takes the first text of the next range that has rows,
    found by the same method over the ranges' first rows.  The texts are shuffled once.
    """
    count = docs.count()
    order = [F.col(id_col).asc_nulls_first(), F.col(text_col)]
    if count <= rows_in_range:
        docs = docs.withColumn(text_col, carry(F.col(text_col)))
        w = Window.partitionBy(F.lit(0)).orderBy(*order)
        first = F.first(text_col).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return docs.withColumn("next", F.coalesce(F.lead(text_col).over(w), first))
    marks = docs.agg(F.percentile_approx(id_col, [i / cuts for i in range(cuts + 1)], 10_000)
                     .alias("q"), F.min(id_col).alias("a"), F.max(id_col).alias("b")).first()
    q = sorted({marks["a"], marks["b"], *marks["q"]}) if marks["q"] else [0]
    steps = max(1, -(-count // (rows_in_range * len(q))))
    widths = [max(1, -(-(b - a) // steps)) for a, b in zip(q, q[1:])] + [1]
    longs = [F.array(*[F.lit(x).cast("decimal(20,0)") for x in xs]) for xs in (q, widths)]
    inside = F.size(F.filter(longs[0], lambda x: x <= F.col(id_col)))
    place = F.expr(f"(cast({id_col} as decimal(20,0)) - element_at(_q, _i)) div element_at(_w, _i)")
    ranged = (docs.withColumns({"_q": longs[0], "_w": longs[1],
                                "_i": F.when(F.col(id_col).isNotNull(), inside)})
              .withColumn("_range", F.coalesce(F.col("_i") * F.lit(steps + 1) + place, F.lit(-1)))
              .drop("_q", "_i", "_w"))
    # a row without an id sorts first, in a range of its own
    least = F.min(F.struct(F.coalesce(F.col(id_col), F.lit(0)), F.col(text_col).alias("t")))
    firsts = materialise(ranged.groupBy("_range").agg(least.alias("k"))
                         .select(F.col("_range").alias("_key"), F.col("k.t").alias("_text")),
                         "iblt-firsts")
    after = materialise(with_next(firsts, "_key", "_text", rows_in_range, cuts)
                        .select(F.col("_key").alias("_match"), F.col("next").alias("_after")),
                        "iblt-next")
    # it stands as an extra row at the end of the range, so that no join moves the texts again
    ends = after.select(F.col("_match").alias("_range"), carry(F.col("_after")).alias(text_col),
                        F.lit(1).alias("_end"))
    rows = ranged.withColumn(text_col, carry(F.col(text_col))).withColumn("_end", F.lit(0)).unionByName(ends, allowMissingColumns=True)
    w = Window.partitionBy("_range").orderBy("_end", *order)
    return (rows.withColumn("next", F.lead(text_col).over(w)).where("_end = 0")
            .drop("_range", "_end"))


def _entry_rows(rows: DataFrame, keys: list[str], ids: Column, sign: Column, cells: Column) -> DataFrame:
    """``rows`` as sketch entries, keys, p, n, id and ck: three for each digest."""
    third = F.floor(F.col("_m") / 3).cast("int")
    return (rows.select(*keys, cells.cast("int").alias("_m"), sign.alias("n"), F.explode(ids).alias("id"))
            .select("*", F.explode(F.array(*[F.lit(t) for t in range(3)])).alias("_t"))
            .select(*keys, "_m", (F.pmod(F.xxhash64("_t", "id"), third).cast("int") + third * F.col("_t")).alias("p"),
                    "n", "id", _check(F.col("id")).alias("ck")))


def _cell_rows(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Entry rows as cell rows, empty cells left out."""
    return entries.groupBy(*keys, "p").agg(
        F.sum("n").cast("int").alias("n"), F.bit_xor("id").alias("id"), F.bit_xor("ck").alias("ck")).where(
        "n != 0 or id != 0 or ck != 0")


def peel_rows(cells: DataFrame, keys: list[str], rounds: int) -> DataFrame:
    """Sketch differences as rows, keys, _m (cells in all), p, n, id and ck, peeled: keys, only_a,
    only_b (how many digests were recovered with sign 1, -1) and left (cells not peeled), of
    each difference that is not empty.  Nothing is shuffled if ``cells`` are dealt by the keys.

    A round peels one third of the cells, the thirds in turn: there a digest has one cell, so
    that none is found twice and a round is one aggregation.  Cells that hold a single digest
    are dropped, and it is taken out of its cells in the other thirds.  Found digests are only
    counted on, in a row of place -1.
    """
    zero, third = F.lit(0).cast("bigint"), F.floor(F.col("_m") / 3).cast("int")
    keys = [*keys, "_m"]
    state = cells.select(*keys, "p", "n", "id", "ck", zero.alias("a"), zero.alias("b"))
    at = F.col("_t")
    for k in range(rounds):
        mine = k % 3
        found = ((F.col("p") >= third * mine) & (F.col("p") < third * (mine + 1)) & (F.abs("n") == 1)
                 & (_check(F.col("id")) == F.col("ck")))
        others = [F.lit(t) for t in range(3) if t != mine]
        # what becomes of a row: -2 it stays, -1 its digest is counted, else it leaves that third
        moved = state.select("*", F.explode(F.when(found, F.array(F.lit(-1), *others)).otherwise(
            F.array(F.lit(-2)))).alias("_t")).select(
            *keys,
            F.when(at == -2, F.col("p")).when(at == -1, F.lit(-1)).otherwise(
                F.pmod(F.xxhash64(at, F.col("id")), third).cast("int") + third * at).alias("p"),
            F.when(at == -2, F.col("n")).when(at == -1, F.lit(0)).otherwise(-F.col("n")).alias("n"),
            *[F.when(at == -1, zero).otherwise(F.col(c)).alias(c) for c in ("id", "ck")],
            *[F.when(at == -1, (F.col("n") == sign).cast("bigint")).when(at == -2, F.col(c)).otherwise(zero).alias(c)
              for c, sign in (("a", 1), ("b", -1))])
        state = moved.groupBy(*keys, "p").agg(
            F.sum("n").cast("int").alias("n"), F.bit_xor("id").alias("id"), F.bit_xor("ck").alias("ck"),
            F.sum("a").alias("a"), F.sum("b").alias("b")).where("p = -1 or n != 0 or id != 0 or ck != 0")
    return state.groupBy(*keys[:-1]).agg(F.sum("a").alias("only_a"), F.sum("b").alias("only_b"),
                                         F.count(F.when(F.col("p") >= 0, 1)).alias("left"))


def differences(rows: DataFrame, pairs: list[tuple[str, str]], factor: int, rounds: int = 6) -> DataFrame:
    """For each row, by its unique ``r``, and each pair ``c`` of digest set columns: r, c,
    only_a, only_b, left as of ``peel_rows``, from sketches of ``factor`` cells for each
    digest of the expected difference.  Pairs without a difference have no row."""
    keys = ["r", "c"]
    # a row for each pair and each of its sides
    sides = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.lit(s).alias("s"))
                                for c in range(len(pairs)) for s in (1, -1)]))

    def chosen(of, default: Column) -> Column:
        out = default
        for c, (x, y) in enumerate(pairs):
            for s, name in ((1, x), (-1, y)):
                out = F.when((F.col("k.c") == c) & (F.col("k.s") == s), of(c, name)).otherwise(out)
        return out

    def size(x: str, y: str) -> Column:
        a, b = F.col(x), F.col(y)
        return F.greatest(F.least(expected_difference(a, b), (F.size(a) + F.size(b)).cast("double")).cast("int")
                          * factor, F.lit(FEWEST))

    sized = rows.select("r", *{n for p in pairs for n in p}, *[size(x, y).alias(f"m{c}")
                                                               for c, (x, y) in enumerate(pairs)])
    dealt = sized.select("*", sides.alias("k")).select(
        "r", F.col("k.c").alias("c"), F.col("k.s").alias("s"),
        chosen(lambda c, _: F.col(f"m{c}"), F.lit(None)).alias("m"),
        chosen(lambda _, n: F.col(n), F.lit(None)).alias("set"))
    entries = _entry_rows(dealt, keys, F.col("set"), F.col("s"), F.col("m"))
    return peel_rows(_cell_rows(entries, [*keys, "_m"]), keys, rounds)


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      chars_in_task: int = 2 << 20) -> DataFrame:
    """Each text against an edited version and against the next document.

    Edited: the last quarter (rounded down, in code points) replaced by as many of the
    first of the next document.  Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next; one row per input row.  A null text
    counts as empty; a single row is its own next; repeated ids are in order of their
    texts; null ids come first; other columns are not looked at; an empty table stays
    empty.

    Sketches are made and peeled as rows, one for a cell, by aggregations that stay in
    the task a text is dealt to; about ``chars_in_task`` characters' sketches go to one.
    Likenesses come from the fingerprints where their difference can be peeled, else
    from larger sketches, retried twice and four times as large where those stall.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a text travels with its digests: they are its own and the row's before it
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("it"))
    rows = with_next(rows, "doc_id", "it", carry=lambda t: F.struct(
        t.alias("text"), digests(t).alias("set"))).select(
        "doc_id", F.col("it.text").alias("text"), F.col("it.set").alias("a"),
        F.col("next.text").alias("next"), F.col("next.set").alias("b"))
    n = F.char_length("text")
    taken = F.floor(n / 4).cast("int")
    rows = rows.withColumn("n", n.cast("bigint")).withColumn(
        "edited", F.concat(F.substr(F.col("text"), F.lit(1), n - taken),
                           F.substr(F.col("next"), F.lit(1), taken)))
    rows = materialise(rows.select(
        F.monotonically_increasing_id().alias("r"), "doc_id", "n", F.sha2("edited", 256).alias("edited_sha256"),
        "a", digests(F.col("edited")).alias("e"), "b"), "iblt-sets")
    chars = rows.agg(F.sum("n")).first()[0] or 0
    tasks = max(shuffle_width(docs.sparkSession), -(-chars // chars_in_task))
    sets = rows.select("r", "a", "e", "b").repartition(tasks, "r")
    pairs = [("a", "e"), ("a", "b")]

    # the fixed sketches, which are the fingerprints, and their differences
    sides = sets.select("r", F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("side"), "a", "e", "b")
    chosen = F.when(F.col("side") == 0, F.col("a")).when(F.col("side") == 1, F.col("e")).otherwise(F.col("b"))
    cells = _cell_rows(_entry_rows(sides, ["r", "side"], chosen, F.lit(1), F.lit(CELLS)), ["r", "side"])
    fixed = cells.groupBy("r").agg(F.sort_array(F.collect_list(F.struct("side", "p", "n", "id", "ck"))).alias("all"))
    fixed = fixed.select("r", *[F.transform(F.filter("all", lambda c: c["side"] == k), lambda c: F.struct(
        *[c[f].alias(f) for f in ("p", "n", "id", "ck")])).alias(f"s{k}") for k in range(3)])

    def counted(c: int) -> Column:
        return F.transform(F.array(peel(subtract(F.col("s0"), F.col(f"s{c + 1}")), CELLS)), lambda d: F.when(
            d.isNotNull(), F.struct(F.size(F.filter(d, lambda e: e["sign"] == 1)).cast("bigint").alias("only_a"),
                                    F.size(F.filter(d, lambda e: e["sign"] == -1)).cast("bigint").alias("only_b"))))[0]

    fixed = fixed.select("r", fingerprint(F.col("s0")).alias("fingerprint"),
                         fingerprint(F.col("s1")).alias("edited_fingerprint"),
                         *[counted(c).alias(f"d{c}") for c in range(2)])

    # larger sketches, and again where one stalled
    larger = materialise(differences(sets, pairs, RETRIES[-1]), "iblt-differences")
    done, stalled = larger.where("left = 0").drop("left"), larger.where("left > 0").select("r", "c")
    for times in (2, 4):
        if stalled.isEmpty():
            break
        again = rows.select("r", "n", "a", "e", "b").join(stalled.select("r").distinct(), "r", "left_semi")
        # as many characters' sketches in a task as above, of fewer texts
        left = again.agg(F.sum("n")).first()[0] or 0
        width = max(shuffle_width(docs.sparkSession), -(-left * times // chars_in_task))
        more = materialise(differences(again.drop("n").repartition(width, "r"), pairs, RETRIES[-1] * times)
                           .join(stalled, ["r", "c"], "left_semi"), "iblt-again")
        done = done.unionByName(more.where("left = 0").drop("left"))
        stalled = more.where("left > 0").select("r", "c")
    else:
        # what none can peel is compared as sets (about never)
        for c, (x, y) in enumerate(pairs):
            done = done.unionByName(rows.join(stalled.where(F.col("c") == c), "r", "left_semi").select(
                "r", F.lit(c).alias("c"), F.size(F.array_except(x, y)).cast("bigint").alias("only_a"),
                F.size(F.array_except(y, x)).cast("bigint").alias("only_b")))
    found = done.groupBy("r").agg(*[F.first(F.when(F.col("c") == c, F.struct("only_a", "only_b")), True).alias(
        f"l{c}") for c in range(2)])

    out = (rows.select("r", "doc_id", "n", "edited_sha256", *[F.size(x).cast("bigint").alias(f"n_{x}") for x in "aeb"])
           .join(fixed, "r", "left").join(found, "r", "left"))

    def near(c: int, size: str) -> Column:
        # no row of a larger sketch: nothing differs
        none = F.struct(F.lit(0).cast("bigint").alias("only_a"), F.lit(0).cast("bigint").alias("only_b"))
        d = F.coalesce(F.col(f"d{c}"), F.col(f"l{c}"), none)
        union = F.col("n_a") + d["only_b"]
        return F.when(union == 0, F.lit(1.0)).otherwise((F.col("n_a") - d["only_a"]) / union).cast("double")

    return out.select(
        "doc_id", F.col("n").alias("n_chars"), "edited_sha256",
        F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
        near(0, "e").alias("near_edited"), near(1, "b").alias("near_next"))
