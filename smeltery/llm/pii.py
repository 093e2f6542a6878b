"""Personal data: patterns, and terms that disclose what the patterns protect.

Built on DataFrame functions alone.

Patterns find e-mail addresses, IP addresses, card and phone numbers; each value is a protected entity. A term (a run of
letters, ASCII lower case) discloses an entity when seeing the term tells most of what the entity's own
appearance would: with counts of documents over the whole corpus, pointwise mutual information

    log2(believed * documents(term near entity) * documents / (documents(term) * documents(entity)))

is at least ``DISCLOSURE`` of the entity's information content, log2(documents / documents(entity)). Near means among the
``NEAR`` words on either side of the entity, across line breaks, so pairs grow with the text and not with its square. No
entity is left out for being rare: ``believed`` is d / (d + ``DOUBT``), where d counts the different lines that the
entity is in, one of each document that has term and entity near each other. So copies of one line count once, and the
rarer an entity is in the corpus, the less it takes: from some thousand documents on, a term of one document near an
entity of that document alone is removed. Such terms are removed wherever a document also holds the entity; entities
are generalised to their kind.

No pattern reaches across a line break, so entities can be looked for line by line. Possessive quantifiers and
look-behind keep patterns linear and free of recursion on long runs, and match what the plain ones match.

Defined results: a null text counts as empty and has no spans; every row gets its result; rows that agree in id
and text get equal results. Only the named columns are read, and stages carry the others along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, documents, text_or_empty, written

DISCLOSURE = 0.8
NEAR = 10
#: Imagined lines that hold a term without the entity, added to those seen.
DOUBT = 3

_LOCAL = r"[A-Za-z0-9._%+-]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Kinds in order, and the pattern that finds each.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]


def luhn(digits: Column) -> Column:
    """Whether the digits, from the last, every second one doubled, add up to a multiple of ten."""

    def add(total: Column, digit: Column) -> Column:
        doubled = digit * (1 + total["odd"])
        return F.struct(
            (total["sum"] + F.when(doubled > 9, doubled - 9).otherwise(doubled)).alias("sum"),
            (1 - total["odd"]).alias("odd"),
        )

    each = F.transform(F.split(F.reverse(digits), ""), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("odd"))
    return F.aggregate(each, start, add, lambda total: total["sum"] % 10 == 0)


def is_valid(kind: Column, value: Column) -> Column:
    """The checks a match must pass, by its kind's number."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    card = F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    return (
        F.when(kind == 0, True)
        .when(kind == 1, value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == 2, card)
        .otherwise(F.length(digits).between(9, 15))
    )


def _matches(text: Column, parts: bool = False) -> Column:
    """For each kind that matches at all: its number, the matches, and the lengths of the gaps around them.

    With ``parts``, the texts of the gaps instead.
    """
    needs = {"email": "@", "ip": ".", "phone": "+"}  # a cheap look for what a pattern cannot do without
    found = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        possible = F.contains(text, F.lit(needs[kind])) if kind in needs else F.lit(True)
        if kind != "email":
            possible = possible & text.rlike("[0-9]")
        between = F.split(text, pattern)
        gaps = between.alias("parts") if parts else F.transform(between, lambda g: F.length(g)).alias("gaps")
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        found.append(F.when(possible, F.struct(F.lit(number).alias("kind"), gaps, hits.alias("hits"))))
    return F.filter(F.array(*found), lambda m: m.isNotNull() & (F.size(m["hits"]) > 0))


def _placed(matches: DataFrame) -> DataFrame:
    """Start and end of each match, in code points, from rows with ``gaps`` and ``hits``."""
    # The last gap has no match after it.
    each = F.posexplode(F.arrays_zip(F.slice("gaps", 1, F.size("hits")).alias("gap"), F.col("hits").alias("hit")))
    rows = matches.select("id", "hash", "kind", each.alias("n", "m"))
    rows = rows.select("id", "hash", "kind", "n", F.col("m")["gap"].alias("gap"), F.col("m")["hit"].alias("value"))
    rows = rows.distinct()  # equal rows of the input are one document
    order = Window.partitionBy("id", "hash", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(order)
    return rows.select("id", "hash", "kind", (end - F.length("value")).alias("start"), end.alias("end"), "value")


def _named(docs: DataFrame, id: str, text: str) -> DataFrame:
    filled = text_or_empty(text)
    return docs.select(F.col(id).alias("id"), F.xxhash64(filled).alias("hash"), filled.alias("text"))


def holders(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with a valid match, written: ``id``, ``hash``, ``text``. All that follows reads these, but for counts of terms."""
    valid = F.exists(_matches(F.col("text")), lambda m: F.exists(m["hits"], lambda hit: is_valid(m["kind"], hit)))
    return written(_named(docs, id, text).where(valid), "holders")


def pattern_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per valid match: id, hash of the text, number of the kind, start, end, value."""
    found = _named(docs, id, text).select("id", "hash", F.explode(_matches(F.col("text"))).alias("m"))
    spans = _placed(found.select("id", "hash", "m.*"))
    return spans.where(is_valid(F.col("kind"), F.col("value")))


def _entity(kind: Column, value: Column) -> Column:
    """One name for spellings of one entity."""
    plain = F.when(kind == 0, F.lower(value)).when(kind == 1, value).otherwise(F.regexp_replace(value, "[^0-9]", ""))
    return F.concat_ws(":", kind.cast("string"), plain)


def _letter_runs(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), r"[^\p{L}]+"), lambda t: t != "")


def _mentions(text: Column, near: int) -> Column:
    """Each valid match of a text: its entity, the terms near it, and a digest of the line it is in."""

    def of_kind(m: Column) -> Column:
        def mention(hit: Column, i: Column) -> Column:
            begun = F.substring_index(F.get(m["parts"], i), "\n", -1)
            line = F.concat(begun, hit, F.substring_index(F.get(m["parts"], i + 1), "\n", 1))
            before = F.filter(F.split(F.get(m["parts"], i), r"[\x20\x09-\x0D]+"), lambda w: w != "")
            after = F.filter(F.split(F.get(m["parts"], i + 1), r"[\x20\x09-\x0D]+"), lambda w: w != "")
            first = F.greatest(F.size(before) - near + 1, F.lit(1))
            around = F.concat(F.slice(before, first, F.lit(near)), F.slice(after, F.lit(1), F.lit(near)))
            return F.when(
                is_valid(m["kind"], hit),
                F.struct(
                    _entity(m["kind"], hit).alias("entity"),
                    F.array_distinct(_letter_runs(F.array_join(around, " "))).alias("terms"),
                    F.md5(line).alias("line"),
                ),
            )

        return F.filter(F.transform(m["hits"], mention), lambda x: x.isNotNull())

    return F.flatten(F.transform(_matches(text, parts=True), of_kind))


def disclosing_terms(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    disclosure: float = DISCLOSURE,
    doubt: float = DOUBT,
    near: int = NEAR,
    held: DataFrame | None = None,
) -> DataFrame:
    """Pairs of an entity and a term that discloses it, by documents, of entities however rare.

    ``held`` is what ``holders`` gives for the documents, if it is there already.
    """
    rows = _named(docs, id, text)
    mentions = (held or holders(docs, id, text)).select("id", "hash", F.explode(_mentions(F.col("text"), near)).alias("m"))
    mentions = written(mentions.select("id", "hash", "m.*"), "mentions")

    def counted(found: DataFrame, *names: str) -> DataFrame:
        """Documents by the names, those with the same line of the entity once in ``different``. Of several lines the first digest counts."""
        own = found.groupBy("id", "hash", *names).agg(F.min("line").alias("line"))
        by_line = own.groupBy("line", *names).agg(F.count(F.lit(1)).alias("documents"))
        return by_line.groupBy(*names).agg(F.sum("documents").alias("documents"), F.count(F.lit(1)).alias("different"))

    entities = counted(mentions, "entity").select("entity", F.col("documents").alias("entity_documents"))
    pairs = counted(mentions.select("id", "hash", "line", "entity", F.explode("terms").alias("term")), "entity", "term")
    pairs = written(pairs, "pairs")
    # Counted before the join, so that what moves is a row per term and task, not one per word.
    terms = rows.select(F.explode(F.array_distinct(_letter_runs(F.col("text")))).alias("term"))
    known = pairs.join(terms.groupBy("term").agg(F.count(F.lit(1)).alias("term_documents")), "term")
    known = known.join(entities, "entity")
    n = F.lit(float(docs.count()))
    believed = F.col("different") / (F.col("different") + F.lit(float(doubt)))
    information = F.log2(
        believed * F.col("documents") * n / (F.col("term_documents") * F.col("entity_documents"))
    )
    content = F.log2(n / F.col("entity_documents"))
    return known.where(information >= disclosure * content).select("entity", "term")


def _told(texts: DataFrame, held: DataFrame, disclosing: DataFrame) -> DataFrame:
    """Terms that disclose an entity of the same document, from the terms it has. ``held`` has the entities of each of the texts.

    An entity may have as many terms as documents, most of them in one document each, so that all terms of an
    entity for all its documents would be a square.
    """
    terms = texts.select("id", "hash", F.explode(F.array_distinct(_letter_runs(F.col("text")))).alias("term"))
    terms = terms.join(disclosing.select("term").distinct(), "term", "left_semi")
    both = terms.join(held, ["id", "hash"]).join(disclosing, ["entity", "term"], "left_semi")
    return both.select("id", "hash", "term").distinct()


def personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """A row per span: ``id``, ``hash`` of the text, number of the kind, ``start``, ``end``. Terms inside other spans are left to them."""
    texts = holders(docs, id, text)
    base = written(pattern_spans(texts, "id"), "spans")
    disclosing = written(disclosing_terms(docs, id, text, held=texts, **limits), "disclosing")
    held = base.select("id", "hash", _entity(F.col("kind"), F.col("value")).alias("entity")).distinct()
    told = written(_told(texts, held, disclosing), "told")
    concerned = told.select("id", "hash").distinct()
    same = ["id", "hash"]
    words = texts.join(concerned, same, "left_semi")
    runs = words.select(
        "id",
        "hash",
        F.lit(KINDS.index("term")).alias("kind"),
        F.transform(F.split("text", r"\p{L}+"), lambda g: F.length(g)).alias("gaps"),
        F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)).alias("hits"),
    )
    placed = _placed(runs).withColumn("term", ascii_lower(F.col("value")))
    terms = placed.join(told, ["id", "hash", "term"], "left_semi").drop("term")
    covers = F.collect_list(F.struct("start", "end"))
    spans = base.groupBy("id", "hash").agg(covers.alias("base"))
    inside = F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    outside = terms.join(spans, same).where(~inside).select("id", "hash", "kind", "start", "end")
    return base.select("id", "hash", "kind", "start", "end").unionByName(outside)


def spans_by_document(docs: DataFrame, id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """``id``, ``hash``, and ``spans``: structs of kind, start and end, sorted. Only texts with spans have a row."""
    found = personal_data(docs, id, text, **limits)
    one = F.struct("kind", "start", "end")
    return found.groupBy("id", "hash").agg(F.sort_array(F.collect_list(one)).alias("spans"))


def sanitise(docs: DataFrame, id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """All rows and columns; in texts, entities become their kind in brackets and disclosing terms ``[TERM]``.

    Spans that overlap are covered together, under the name of the one that starts first, of those the longest.
    ``n_chars``, where the table has it, follows the text.
    """
    spans = spans_by_document(docs, id, text, **limits).select(
        F.col("id").alias("_id"), F.col("hash").alias("_hash"), "spans"
    )
    filled = text_or_empty(text)
    rows = docs.select(F.struct("*").alias("_row"), F.col(id).alias("_doc"), F.xxhash64(filled).alias("_text_hash"))
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    joined = rows.join(spans, same, "left").select("_row", "spans")
    whole = F.col("_row")[text]
    in_order = F.sort_array(
        F.transform("spans", lambda s: F.struct(s["start"], (-s["end"]).alias("by"), s["end"], s["kind"]))
    )
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def add(done: Column, s: Column) -> Column:
        between = F.substring(whole, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        grown = F.struct(
            F.concat(done["parts"], F.array(between, F.get(names, s["kind"]))).alias("parts"), s["end"].alias("at")
        )
        covered = F.struct(done["parts"].alias("parts"), F.greatest(done["at"], s["end"]).alias("at"))
        return F.when(s["start"] >= done["at"], grown).otherwise(covered)

    begin = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("bigint").alias("at"))
    rest = F.aggregate(
        in_order,
        begin,
        add,
        lambda done: F.concat(
            F.array_join(done["parts"], ""),
            F.substring(whole, (done["at"] + 1).cast("int"), F.length(whole)),
        ),
    )
    out = joined.select("_row", F.when(F.col("spans").isNull(), whole).otherwise(rest).alias("_text"))
    new = {text: F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text_or_empty("_text")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def op10_personal_data(spark, sf_dir):
    docs = documents(spark, sf_dir)
    spans = spans_by_document(docs)
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("hash"))
    joined = rows.join(spans, same, "left")
    names = F.array(*[F.lit(k) for k in KINDS])
    found = F.coalesce("spans", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>"))

    def listed(items: Column) -> Column:
        text = F.transform(items, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
        return F.array_join(text, ",")

    def of(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    term = KINDS.index("term")
    return joined.withColumn("spans", found).select(
        "doc_id",
        *[of(i).alias(f"n_{kind}") for i, kind in enumerate(PATTERNS)],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] < term)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


#: The same patterns as a user of another engine writes them.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _found(source: str, keys: str, text: str) -> str:
    """Matches of every kind, and the texts between them."""
    return "\n  UNION ALL ".join(
        f"SELECT {keys}, {n} AS kind, regexp_extract_all({text}, '{p}') AS hits, "
        f"string_split_regex({text}, '{p}') AS gaps FROM {source} WHERE regexp_matches({text}, '{p}')"
        for n, p in enumerate(_PLAIN.values())
    )


_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_VALID = f"""CASE kind WHEN 0 THEN true
    WHEN 1 THEN list_max(list_transform(string_split(v, '.'), lambda x: CASE
      WHEN length(ltrim(x, '0')) > 3 THEN 999 WHEN ltrim(x, '0') = '' THEN 0 ELSE ltrim(x, '0')::INT END)) <= 255
    WHEN 2 THEN length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(
      range(length({_DIGITS})), lambda i: CASE WHEN i % 2 = 0 THEN reverse({_DIGITS})[i + 1]::INT
        ELSE 2 * reverse({_DIGITS})[i + 1]::INT - CASE WHEN reverse({_DIGITS})[i + 1]::INT > 4 THEN 9 ELSE 0 END
      END)) % 10 = 0
    ELSE length({_DIGITS}) BETWEEN 9 AND 15 END"""
_NAME = f"kind || ':' || CASE kind WHEN 0 THEN lower(v) WHEN 1 THEN v ELSE {_DIGITS} END"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _listed(kinds: str) -> str:
    items = f"list_transform({kinds}, lambda x: {KINDS}[x.kind + 1] || ':' || x.a || ':' || x.e)"
    return f"array_to_string({items}, ',')"


OP10_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_found("d", "doc_id", "text")}),
each AS (
  SELECT doc_id, kind, unnest(hits) AS v, unnest(gaps[1:len(hits)]) AS g, unnest(range(len(hits))) AS n FROM m),
placed AS (
  SELECT doc_id, kind, v,
    (sum(length(g) + length(v)) OVER (PARTITION BY doc_id, kind ORDER BY n))::BIGINT AS e FROM each),
base AS (SELECT doc_id, kind, v, e - length(v) AS a, e, {_NAME} AS entity FROM placed WHERE {_VALID}),
mention AS (
  SELECT doc_id, kind, unnest(hits) AS v, unnest(gaps[1:len(hits)]) AS before, unnest(gaps[2:len(hits) + 1]) AS after
  FROM m),
near AS (
  SELECT doc_id, {_NAME} AS entity,
    md5(string_split(before, chr(10))[-1] || v || string_split(after, chr(10))[1]) AS line,
    list_distinct(list_filter(string_split_regex({_lower(
        "array_to_string(list_concat(regexp_extract_all(before, '[^\\x20\\x09-\\x0D]+')[-10:], "
        "regexp_extract_all(after, '[^\\x20\\x09-\\x0D]+')[1:10]), ' ')"
    )}, '[^\p{{L}}]+'), lambda t: t <> '')) AS terms
  FROM mention WHERE {_VALID}),
entities AS (SELECT entity, count(DISTINCT doc_id) AS documents FROM near GROUP BY entity),
pairs AS (
  SELECT entity, term, count(*) AS documents, count(DISTINCT line) AS different
  FROM (SELECT doc_id, entity, term, min(line) AS line
    FROM (SELECT doc_id, line, entity, unnest(terms) AS term FROM near) GROUP BY doc_id, entity, term)
  GROUP BY entity, term),
words AS (
  SELECT term, count(*) AS documents
  FROM (SELECT unnest(list_distinct(string_split_regex({_lower("text")}, '[^\p{{L}}]+'))) AS term FROM d)
  WHERE term IN (SELECT term FROM pairs) GROUP BY term),
total AS (SELECT count(*)::DOUBLE AS n FROM d),
telling AS (
  SELECT p.entity, p.term FROM pairs p JOIN words w USING (term) JOIN entities x USING (entity), total
  WHERE log2(different / (different + {float(DOUBT)}) * p.documents * n / (w.documents * x.documents))
    >= {DISCLOSURE} * log2(n / x.documents)),
told AS (SELECT DISTINCT doc_id, term FROM base JOIN telling USING (entity)),
runs AS (
  SELECT doc_id, regexp_extract_all(text, '\p{{L}}+') AS hits, string_split_regex(text, '\p{{L}}+') AS gaps
  FROM d WHERE doc_id IN (SELECT doc_id FROM told)),
run AS (
  SELECT doc_id, unnest(hits) AS v, unnest(gaps[1:len(hits)]) AS g, unnest(range(len(hits))) AS n FROM runs),
run_placed AS (
  SELECT doc_id, v, (sum(length(g) + length(v)) OVER (PARTITION BY doc_id ORDER BY n))::BIGINT AS e FROM run),
terms AS (
  SELECT r.doc_id, 4 AS kind, e - length(v) AS a, e
  FROM run_placed r JOIN told ON told.doc_id = r.doc_id AND told.term = {_lower("v")}
  WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.a < r.e AND r.e - length(r.v) < b.e)),
spans AS (
  SELECT doc_id, list({{'kind': kind, 'a': a, 'e': e}} ORDER BY kind, a, e) AS s
  FROM (SELECT doc_id, kind, a, e FROM base UNION ALL SELECT * FROM terms) GROUP BY doc_id),
filled AS (SELECT doc_id, coalesce(s, []) AS s FROM d LEFT JOIN spans USING (doc_id))
SELECT doc_id, {", ".join(f"len(list_filter(s, lambda x: x.kind = {n}))::BIGINT AS n_{k}" for n, k in enumerate(_PLAIN))},
  sha256({_listed("list_filter(s, lambda x: x.kind < 4)")}) AS base_sha256, {_listed("s")} AS spans
FROM filled
"""
