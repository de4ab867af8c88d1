"""Personal data: base patterns plus information-theoretic sanitisation.

Base spans (email, ip, card, phone) are found by regular expressions. They are the
protected entities. Any other term of a text that holds an entity may reveal it as well.
With the different texts of the corpus as events (copies of one text are one event),

    IC(c)    = log2(N / n(c))                     information of entity c
    PMI(c;t) = log2(n(c,t) N / (n(c) n(t)))       what term t tells about c
    d(c;t)   = PMI(c;t) / IC(c)                   share of c's information, at most 1

where n(c), n(t) and n(c,t) count the texts with the entity, the term, and both anywhere
in them. All four counts leave one text out (1 is taken from each): what the other texts
tell is the evidence, as in its own text every word comes with the entity. So a pair
needs two texts and no further support. A term with d >= ``remove`` is removed and one
with d >= ``generalise`` is replaced by its class (``<CODE>`` with a digit, ``<NAME>`` with
a capital first, else ``<WORD>``), at each of its places in every text with that entity.

All of it is DataFrame expressions. Matches are cut from the row by ``split`` and
``regexp_extract_all``, and positions (code points) are sums of piece lengths. Counts are
combined before the shuffle. As n(c,t) is at most n(c) and n(t), a pair can reach
``generalise`` only if log2(N / max(n(c), n(t))) does: other pairs, and entities or terms of
one text, are left out before entities meet terms (an exact bound). They meet by a join on
the text, so no row holds all pairs of a text. Counts and flagged terms are written before
they are joined, so that adaptive execution can split a hot entity, term or copied text.

Java's matcher recurses on repeated groups, so the patterns below are possessive forms
that find the same spans without recursion or quadratic retries.

Defined results: a NULL or empty text has no spans. A NULL id is a row like any other.
Repeated rows and copies count once, and each gets the spans. A term that overlaps a base span
is not added. Other columns are kept by ``sanitise`` and ignored by ``find``; their names may
clash with nothing here, as the working columns start with an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|\z)){4}"
TERM = r"[\p{L}\p{N}]+"
LABELS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}
SPAN = "array<struct<start:bigint,end:bigint,value:string>>"
PLACES = "array<struct<start:bigint,end:bigint,action:string,label:string>>"


def _spans(text: Column, pattern: str) -> Column:
    """(start, end, value) of every leftmost non-overlapping match, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    sizes = F.zip_with(F.slice(gaps, 1, F.size(found)), found,
                       lambda g, m: F.struct(F.length(g).cast("bigint").alias("gap"), m.alias("m")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["m"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(sizes, start, step, lambda acc: acc["out"])
                  ).otherwise(F.array().cast(SPAN))


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(s, i):
        d = F.substr(back, i, F.lit(1)).cast("int")
        return s + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP_PARTS)
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    plain = F.lower(value) if kind in ("email", "ip") else F.regexp_replace(value, "[^0-9]", "")
    return F.concat(F.lit(kind + ":"), plain)


def base_spans(text: Column) -> dict[str, Column]:
    """Valid spans per kind."""
    out = {}
    for kind in KINDS:
        spans = _spans(text, PATTERNS[kind])
        out[kind] = spans if kind == "email" else F.filter(spans, _validator(kind))
    return out


def _validator(kind: str):
    return lambda s: _valid(kind, s["value"])


def terms(text: Column) -> Column:
    """The different terms of a text outside its addresses, lower-cased one by one (the other
    kinds of spans hold no letters). Terms without a letter are still among them."""
    rest = F.when(text.contains("@"), F.regexp_replace(text, PATTERNS["email"], " ")).otherwise(text)
    return F.array_distinct(F.transform(F.array_distinct(F.split(rest, r"[^\p{L}\p{N}]+")), F.lower))


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: its key and base spans per kind; with spans, also its text and marks."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    spans = base_spans(F.col("_text"))
    found = rows.select("_id", "_text", *[spans[k].alias(f"_{k}") for k in KINDS])
    marks = F.array_sort(F.concat(*[F.transform(f"_{k}", _mark(k)) for k in KINDS]))
    plain = {k: F.transform(f"_{k}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS}
    some = sum((F.size(f"_{k}") for k in KINDS), F.lit(0)) > 0
    return found.select("_id", row_key(F.col("_id"), F.col("_text")).alias("_key"), F.xxhash64("_text").alias("_of"),
                        *[plain[k].alias(f"_{k}") for k in KINDS], F.when(some, marks).alias("_marks"),
                        F.when(some, F.col("_text")).alias("_text"))


def _mark(kind: str):
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), _entity(kind, s["value"]).alias("entity"))


def row_key(id_: Column, text: Column) -> Column:
    """Key of a row by its id and text; equal rows share it."""
    return F.struct(F.coalesce(id_.cast("string"), F.lit("")).alias("id"), F.xxhash64(text).alias("h"))


def _holders(marked: DataFrame) -> DataFrame:
    """One row per different text with an entity: its hash, text and marks."""
    return marked.where("_marks IS NOT NULL").select("_of", "_text", "_marks").dropDuplicates(["_of"])


def _letters(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("term").rlike(r"\p{L}"))


def cooccurrences(docs: DataFrame, marked: DataFrame, holders: DataFrame, text_col: str = "text",
                  generalise: float = 0.6) -> DataFrame:
    """(_of, entity, term, n_c, n_t, total) of every text's pairs that may reach ``generalise``."""
    total = marked.select(F.countDistinct("_of")).first()[0]
    held = holders.select("_of", F.explode(F.array_distinct(F.transform("_marks", lambda m: m["entity"]))).alias("entity"))
    of_entity = materialise(held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
                            .where((F.col("n_c") >= 2) & (F.col("n_c") < total)), "pii-entities")
    most = of_entity.agg(F.max("n_c")).first()[0] or 1
    # The bound below, solved for n(t) with the most frequent entity.
    limit = 2 + 1.000001 * (max(total - 1, 0) ** (1 - generalise)) * ((most - 1) ** generalise)
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    texts = texts.select(F.xxhash64("_text").alias("_of"), "_text").dropDuplicates(["_of"])
    of_term = materialise(_letters(texts.select(F.explode(terms(F.col("_text"))).alias("term"))).groupBy("term")
                          .agg(F.count(F.lit(1)).alias("n_t")).where((F.col("n_t") >= 2) & (F.col("n_t") <= limit)),
                          "pii-term-counts")
    said = _letters(holders.select("_of", F.explode(terms(F.col("_text"))).alias("term")))
    others = F.lit(float(max(total - 1, 1)))
    reach = (F.log2(others / (F.greatest("n_c", "n_t") - 1))
             >= (generalise - 1e-9) * F.log2(others / (F.col("n_c") - 1)))
    return (held.join(of_entity, "entity").join(said.join(of_term, "term"), "_of").where(reach)
            .select("_of", "entity", "term", "n_c", "n_t", F.lit(total).cast("bigint").alias("total")))


def flagged_terms(pairs: DataFrame, generalise: float = 0.6, remove: float = 0.8) -> DataFrame:
    """(entity, term, action, disclosure) of the terms that reveal an entity."""
    both = (pairs.groupBy("entity", "term", "n_c", "n_t", "total").agg(F.count(F.lit(1)).alias("n_ct"))
            .where("n_ct >= 2"))
    n_ct, n_c, n_t, total = [(F.col(c) - 1).cast("double") for c in ("n_ct", "n_c", "n_t", "total")]
    share = F.log2(n_ct * total / (n_c * n_t)) / F.log2(total / n_c)
    return (both.select("entity", "term", share.alias("disclosure")).where(F.col("disclosure") >= generalise)
            .withColumn("action", F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise")))


def _term_class(term: Column) -> Column:
    return (F.when(term.rlike(r"\p{N}"), "<CODE>").when(term.rlike(r"^\p{Lu}"), "<NAME>").otherwise("<WORD>"))


def _places(text: Column, marks: Column, actions: Column) -> Column:
    """(start, end, action, label) of every place of the terms in the map ``actions``, outside the marks."""
    found = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    sizes = F.zip_with(F.slice(F.split(text, TERM, -1), 1, F.size(found)), found,
                       lambda g, m: F.struct(F.length(g).cast("bigint").alias("gap"), m.alias("m")))
    none = F.array().cast(PLACES)

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["m"])
        action = F.try_element_at(actions, F.lower(x["m"]))
        free = ~F.exists(marks, lambda m: (m["start"] < end) & (begin < m["end"]))
        label = F.when(action == "remove", "").otherwise(_term_class(x["m"]))
        place = F.array(F.struct(begin.alias("start"), end.alias("end"), action.alias("action"), label.alias("label")))
        # Only a flagged term adds to the array, so the walk is linear in the text.
        return F.struct(end.alias("at"), F.when(action.isNotNull() & free, F.concat(acc["out"], place.cast(PLACES)))
                        .otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))
    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def _added(pairs: DataFrame, flagged: DataFrame, holders: DataFrame) -> DataFrame:
    """(_of, _added): the places of flagged terms of every text that has some."""
    hit = pairs.select("_of", "entity", "term").join(flagged.select("entity", "term", "action"), ["entity", "term"])
    # A term may be flagged for two entities of a text; removal wins.
    one = hit.groupBy("_of", "term").agg(F.max("action").alias("action"))
    actions = one.groupBy("_of").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("_actions"))
    return holders.join(actions, "_of").select("_of", _places(F.col("_text"), F.col("_marks"), F.col("_actions")).alias("_added"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = 0.6,
         remove: float = 0.8) -> DataFrame:
    """One row per document: id, a span array per kind (``email`` .. ``phone``) and ``term``
    (start, end, action, label), all in code points with exclusive ends."""
    marked = materialise(_marked(docs, id_col, text_col), "pii-marked")
    holders = materialise(_holders(marked), "pii-holders")
    pairs = materialise(cooccurrences(docs, marked, holders, text_col, generalise), "pii-pairs")
    flagged = materialise(flagged_terms(pairs, generalise, remove), "pii-terms")
    added = materialise(_added(pairs, flagged, holders), "pii-places")
    base = ["_key", *[F.col(f"_{k}").alias(k) for k in KINDS]]
    none = F.array().cast(PLACES)
    held = marked.where("_marks IS NOT NULL").drop("_text", "_marks").join(added, "_of", "left")
    return (held.select(F.col("_id").alias("id"), *base, F.coalesce("_added", none).alias("term"))
            .unionByName(marked.where("_marks IS NULL").select(F.col("_id").alias("id"), *base, none.alias("term"))))


def span_text(spans: dict[str, Column]) -> Column:
    """``kind:start:end`` of every span, comma-joined in the given order of kinds."""
    def written(kind):
        return lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))

    parts = [F.transform(c, written(k)) for k, c in spans.items()]
    return F.array_join(F.concat(*parts), ",")


def _rewrite(text: Column, edits: Column) -> Column:
    """``text`` with the edits (start, end, label; sorted) applied. Overlapping edits are
    merged into the one that starts first."""
    def keep(acc, e):
        inside = e["start"] < acc["end"]
        longer = F.concat(F.slice(acc["out"], 1, F.size(acc["out"]) - 1), F.array(F.struct(
            F.element_at(acc["out"], -1)["start"].alias("start"), F.greatest(acc["end"], e["end"]).alias("end"),
            F.element_at(acc["out"], -1)["label"].alias("label"))))
        return F.struct(F.greatest(acc["end"], e["end"]).alias("end"),
                        F.when(inside, longer).otherwise(F.concat(acc["out"], F.array(e))).alias("out"))

    kind = "array<struct<start:bigint,end:bigint,label:string>>"
    merged = F.aggregate(edits, F.struct(F.lit(-1).cast("bigint").alias("end"), F.array().cast(kind).alias("out")),
                         keep, lambda acc: acc["out"])

    def build(m):
        parts = F.transform(m, lambda e, k: F.concat(
            F.substr(text, (F.coalesce(F.get(m, k - 1)["end"], F.lit(0)) + 1).cast("int"),
                     (e["start"] - F.coalesce(F.get(m, k - 1)["end"], F.lit(0))).cast("int")), e["label"]))
        tail = F.substr(text, (F.element_at(m, -1)["end"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(parts, ""), tail)

    return F.transform(F.array(merged), build).getItem(0)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the spans of every text replaced by labels; other columns unchanged.

    Only rows with spans are joined with their edits; the others stay where they are.
    """
    found = find(docs, id_col, text_col, **options)
    def edit(kind):
        return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(LABELS[kind]).alias("label"))

    edits = [F.transform(k, edit(k)) for k in KINDS]
    told = F.transform("term", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label")))
    some = sum((F.size(k) for k in KINDS), F.lit(0)) > 0
    table = found.where(some).select(F.col("_key").alias("_k"), F.array_sort(F.concat(*edits, told)).alias("_edits"))
    table = materialise(table.groupBy("_k").agg(F.first("_edits").alias("_edits")), "pii-edits")
    plain = F.coalesce(F.col(text_col), F.lit(""))
    # The same patterns decide which rows have spans, without a join.
    has = F.lit(False)
    for k, spans in base_spans(plain).items():
        has = has | (F.size(spans) > 0)
    cut = docs.withColumn("_has", has)
    texts = cut.where("_has").drop("_has").withColumn("_key", row_key(F.col(id_col), plain))
    changed = (texts.join(table, F.col("_key") == F.col("_k"))
               .withColumn(text_col, _rewrite(F.col(text_col), F.col("_edits"))).select(*docs.columns))
    return cut.where("NOT _has").select(*docs.columns).unionByName(changed)
