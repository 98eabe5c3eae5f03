"""Personal data: exact base spans, then information-theoretic sanitisation.

DataFrame functions only.  Base spans (email, ip, card, phone) come from regular
expressions and digit checks.  The values found are the *protected entities*; a
term written near an entity may give it away even after the entity itself is
masked.  How strongly is estimated from the whole corpus: with

    n(c)    words that stand within ``window`` characters of entity c,
    n(t)    occurrences of term t in all documents,
    n(c,t)  occurrences of t near c,     N  words of all documents,

the information t gives about c is PMI(c;t) = log2(n(c,t) N / (n(c) n(t))), the
information c carries is IC(c) = log2(N / n(c)), and their ratio is the share of
c's information that t discloses: 1 when t stands nowhere else.  Terms beyond a
threshold are generalised (to a class by their shape), beyond a higher one
removed, in every document that holds c.  Copies of one document are one
witness, not many: all counts are over distinct texts, and a pair counts if it
stands in at least ``contexts`` of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import cut_text, let, materialise, running

KINDS = ("email", "ip", "card", "phone")

# Possessive forms of the contract's patterns: the same matches in linear time and
# without recursion.  A look-behind skips starts inside a run of the leading class
# (its first character, or the end of the last match, has been tried before).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "phone": "+"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP_CHECK = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"

WORD, WORD_SPLIT = r"[\p{L}\p{N}]+", r"[^\p{L}\p{N}]+"
SPAN = "array<struct<s:int,e:int,m:string>>"


def match_spans(text: Column, pattern: Column) -> Column:
    """Leftmost non-overlapping matches as (s, e, m): start, end (exclusive), in code
    points, and match."""
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    before = running(F.zip_with(parts, found, lambda p, m: F.char_length(p) + F.coalesce(
        F.char_length(m), F.lit(0))), lambda a, n: a + n)
    first = F.zip_with(before, parts, lambda b, p: b + F.char_length(p))
    spans = F.zip_with(first, found, lambda s, m: F.struct(
        s.alias("s"), (s + F.char_length(m)).alias("e"), m.alias("m")))
    return F.filter(spans, lambda x: x["m"].isNotNull())  # nothing after the last part


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    ds = F.reverse(F.filter(F.split(digits, ""), lambda d: d != ""))
    doubled = F.transform(ds, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int") + 1)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(IP_CHECK)
    if kind == "card":
        n = F.char_length(_digits(m))
        return F.when(n.between(13, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.char_length(_digits(m)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Valid spans of a kind (see ``match_spans``); an empty array for a null text."""
    pattern = PATTERNS[kind]
    there = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else text.rlike(pattern)
    found = F.filter(match_spans(text, F.lit(pattern)), lambda x: _valid(kind, x["m"]))
    return F.when(there, found).otherwise(F.array().cast(SPAN))


def with_base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``_email``, ``_ip``, ``_card``, ``_phone``: arrays of spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({f"_{k}": base_spans(text, k) for k in KINDS})


def _entity(kind: str, m: Column) -> Column:
    """One spelling for each protected value."""
    value = F.lower(m) if kind == "email" else m if kind == "ip" else _digits(m)
    return F.concat(F.lit(f"{kind}:"), value)


def _entities(kind: str) -> Column:
    return F.transform(f"_{kind}", lambda x: F.struct(
        _entity(kind, x["m"]).alias("entity"), x["s"].alias("s"), x["e"].alias("e")))


def _in_context(text: Column, spans: Column, window: int) -> Column:
    """Spans (entity, s, e) with ``l`` and ``r``: the ``window`` characters of the text
    before and after, whatever other spans lie there.

    The text is cut into blocks of ``window`` characters once, so that a context is
    part of two blocks and many spans do not walk a long text again and again."""
    kind = "array<struct<entity:string,s:int,e:int,l:string,r:string>>"

    def part(blocks: Column, start: Column, length: Column) -> Column:
        k = F.floor(start / window).cast("int")
        two = F.concat(*[F.coalesce(F.get(blocks, k + i), F.lit("")) for i in (0, 1)])
        return F.substr(two, start % window + 1, length)

    def around(found: Column, blocks: Column) -> Column:
        return F.transform(found, lambda x: F.struct(
            x["entity"].alias("entity"), x["s"].alias("s"), x["e"].alias("e"),
            part(blocks, F.greatest(x["s"] - window, F.lit(0)), F.least(x["s"], F.lit(window))).alias("l"),
            part(blocks, x["e"], F.lit(window)).alias("r")))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{window}}}"), F.lit(0))
    return let(spans, kind, lambda found: F.when(F.size(found) > 0, let(
        blocks, kind, lambda b: around(found, b))).otherwise(F.array().cast(kind)))


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def disclosing_terms(docs: DataFrame, text_col: str = "text", window: int = 80,
                     generalise: float = 0.8, remove: float = 0.95,
                     contexts: int = 4) -> tuple[DataFrame, DataFrame]:
    """``(flags, mentions)``: terms per entity, (entity, term, share, action), and the
    entities of each text, (k1, k2, entity), keyed by a 128-bit hash of the text."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    keyed = texts.withColumns(dict(zip(("k1", "k2"), _key(F.col("t")))))
    found = (with_base_spans(keyed, "t")
             .select("k1", "k2", F.explode(_in_context(
                 F.col("t"), F.concat(*map(_entities, KINDS)), window)).alias("x"))
             .select("k1", "k2", "x.*").dropDuplicates(["k1", "k2", "entity", "s"]))

    def words(side: str, start: Column, cut: Column) -> Column:
        """Words with their places in the text; one that the window cuts is left out."""
        full = F.char_length(side) == window
        spans = match_spans(F.lower(side), F.lit(WORD))
        return F.transform(F.filter(spans, lambda w: ~(full & cut(w))), lambda w: F.struct(
            (start + w["s"]).alias("at"), w["m"].alias("term")))

    near = materialise(
        found.select("k1", "k2", "entity", F.concat(
            words("l", F.col("s") - F.char_length(F.lower("l")), lambda w: w["s"] == 0),
            words("r", F.col("e"), lambda w: w["e"] == F.char_length(F.lower("r")))).alias("words")),
        "pii-near")
    mentions = near.select("k1", "k2", "entity").distinct()
    # a word near two mentions counts once, and so does a text, however many copies it has
    pairs = materialise(
        near.select("k1", "k2", "entity", F.explode("words").alias("w"))
        .select("k1", "k2", "entity", "w.*").distinct()
        .groupBy("entity", "term", "k1", "k2").agg(F.count("*").alias("n"))
        .groupBy("entity", "term").agg(F.sum("n").alias("n_ct"), F.count("*").alias("texts"))
        .withColumn("h", F.xxhash64("term")), "pii-pairs")
    mass = pairs.groupBy("entity").agg(F.sum("n_ct").alias("n_c"))
    # the vocabulary goes by hash, and is counted map-side before it is shuffled
    counts = (keyed.dropDuplicates(["k1", "k2"])
              .select(F.explode(F.split(F.lower("t"), WORD_SPLIT)).alias("term"))
              .where("term != ''").groupBy(F.xxhash64("term").alias("h"))
              .agg(F.count("*").alias("n_t")))
    counts = materialise(counts, "pii-terms")
    total = counts.agg(F.coalesce(F.sum("n_t"), F.lit(0)).alias("n")).first()["n"]
    share = (F.log2(F.col("n_ct") * F.lit(float(total)) / (F.col("n_c") * F.col("n_t")))
             / F.log2(F.lit(float(total)) / F.col("n_c")))
    flags = materialise(
        pairs.where(F.col("texts") >= contexts).join(mass, "entity").join(counts, "h")
        .where(F.col("n_c") < total)
        .select("entity", "term", share.alias("share"))
        .where(F.col("share") >= generalise)
        .withColumn("action", F.when(F.col("share") >= remove, "remove").otherwise("generalise")),
        "pii-flags")
    return flags, mentions


def _terms_pattern(terms: Column) -> Column:
    """Whole-word alternatives; terms are letters and digits only."""
    return F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.concat_ws("|", terms),
                    F.lit(r")(?![\p{L}\p{N}])"))


def find_spans(docs: DataFrame, text_col: str = "text", **thresholds) -> DataFrame:
    """``docs`` with arrays of (s, e, m): ``_email``, ``_ip``, ``_card``, ``_phone``, and
    ``_generalise``, ``_remove`` for terms that disclose an entity of the same
    document (those that lie in a base span are left out).

    All rows and columns stay, but for columns of these names; a null text has no spans; equal texts have equal
    spans, whatever their ids; an empty table stays empty.
    """
    names = [f"_{k}" for k in (*KINDS, "generalise", "remove")]
    flags, mentions = disclosing_terms(docs, text_col, **thresholds)
    # one row for each text that holds an entity with a disclosing term
    terms = materialise(
        mentions.join(flags, "entity").groupBy("k1", "k2")
        .agg(F.sort_array(F.collect_set(F.when(F.col("action") == "remove", F.col("term"))))
             .alias("_r"),
             F.sort_array(F.collect_set(F.when(F.col("action") == "generalise", F.col("term"))))
             .alias("_g")), "pii-documents").withColumnsRenamed({"k1": "_k1", "k2": "_k2"})
    # the caller's columns go as one, so that no name of theirs meets one of these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    text = F.col("_text")
    found = with_base_spans(rows, "_text")
    k1, k2 = _key(text)
    found = found.withColumn("_any", F.concat(*[F.col(f"_{k}") for k in KINDS]))
    # the size of `terms` is known, so Spark broadcasts it where that is small
    found = (found.withColumns({"_h1": F.when(F.size("_any") > 0, k1), "_h2": k2})
             .join(terms, (F.col("_h1") == F.col("_k1")) & (F.col("_h2") == F.col("_k2")), "left"))

    def spans(terms: str) -> Column:
        found = match_spans(text, _terms_pattern(F.col(terms)))
        outside = F.filter(found, lambda x: ~F.exists(
            F.col("_any"), lambda b: (x["s"] < b["e"]) & (b["s"] < x["e"])))
        return F.when(F.size(terms) > 0, outside).otherwise(F.array().cast(SPAN))

    # a term that one entity removes is not also generalised for another
    found = found.withColumn("_g", F.array_except("_g", "_r"))
    found = found.withColumns({"_generalise": spans("_g"), "_remove": spans("_r")})
    kept = [F.col(f"_row.`{c}`") for c in docs.columns if c not in names]
    return found.select(*kept, *names)


def _listed(kind: str) -> Column:
    return F.transform(f"_{kind}", lambda x: F.concat_ws(
        ":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           **thresholds) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans."""
    found = find_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                       **thresholds)
    term = F.concat(
        F.transform("_generalise", lambda x: F.struct(x["s"].alias("s"), F.concat_ws(
            ":", F.lit("generalise"), x["s"].cast("string"), x["e"].cast("string")).alias("t"))),
        F.transform("_remove", lambda x: F.struct(x["s"].alias("s"), F.concat_ws(
            ":", F.lit("remove"), x["s"].cast("string"), x["e"].cast("string")).alias("t"))))
    found = found.withColumns({
        "_base": F.concat_ws(",", *[_listed(k) for k in KINDS]),
        "_all": F.concat_ws(",", *[_listed(k) for k in (*KINDS, "generalise", "remove")]),
        "_n": F.size(term)})
    return found.select(
        "doc_id", *[F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.col("_n").cast("bigint").alias("n_term"),
        F.sha2(F.col("_base"), 256).alias("base_sha256"), F.col("_all").alias("spans"))


def _shape(m: Column) -> Column:
    return (F.when(m.rlike(r"^\p{N}+$"), "[NUMBER]").when(m.rlike(r"\p{N}"), "[CODE]")
            .when(m.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]"))


def sanitise(docs: DataFrame, text_col: str = "text", **thresholds) -> DataFrame:
    """``docs`` with every span of ``text_col`` masked: base spans by their kind in
    capitals, generalised terms by a class, removed terms by nothing.  Of spans
    that overlap, the one that starts first (then the longer) is masked with
    whatever the others cover beyond it.  Texts without spans, and null texts,
    are returned as they are; all other columns stay."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(text_col).alias("text"))
    found = find_spans(rows, "text", **thresholds)

    def masks(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda x: F.struct(
            x["s"].alias("s"), (-x["e"]).alias("to"),
            (_shape(x["m"]) if kind == "generalise" else F.lit("") if kind == "remove"
             else F.lit(f"[{kind.upper()}]")).alias("by")))

    spans = F.array_sort(F.concat(*map(masks, (*KINDS, "generalise", "remove"))))
    # what stands before each span since the last masked end, then its mask
    ends = running(F.transform("spans", lambda x: -x["to"]), lambda a, n: F.greatest(a, n))

    def masked(part) -> Column:
        last = F.array_max(F.transform("spans", lambda x: -x["to"]))
        return F.concat(F.concat_ws("", F.zip_with("spans", F.col("ends"), lambda x, end: F.when(
            x["s"] >= end, F.concat(F.when(x["s"] > end, part(end, x["s"])).otherwise(""), x["by"]))
            .otherwise(""))), F.when(last < F.char_length("text"), part(last, F.char_length("text")))
            .otherwise(""))

    done = F.when(F.size("spans") > 0, cut_text(F.col("text"), "string", masked)).otherwise(F.col("text"))
    found = found.withColumn("spans", spans).withColumn("ends", ends).withColumn("done", done)
    return found.select(*[F.col("done").alias(c) if c == text_col else F.col(f"row.`{c}`")
                          for c in docs.columns])
