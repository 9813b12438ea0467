"""Personal data: base patterns, and terms that disclose a protected entity by co-occurrence.

The base patterns find e-mail addresses, IP addresses, payment card and phone numbers. Each found value is a
protected entity e. The corpus then tells how much a term t (a word of four letters or more) discloses: with p
over documents, PMI(t; e) = log p(t, e) / (p(t) p(e)) as a share of the information IC(e) = -log p(e). At a
share of 1 every document with t has e. The doubt about small counts is in the estimate: p(e|t) is the lower
end of its Wilson interval at ``Z``, so no count is left out and few sightings weigh less. A term discloses an entity at a
share of ``THRESHOLD`` or above where p(e|t) is ``LIKELY`` or above too: for a rare entity any single sighting has a high
share, but says little about the next one (one of one has a lower end of 0.38, two of two 0.55). Terms that disclose
any entity become spans of kind ``term`` in all documents, with the entity or without it;
``sanitised`` generalises spans to their kind, and removes terms that disclose all (``REMOVE``).

Terms and entities meet anywhere in a document. Four steps bound the work and leave the result as it is:
``LIKELY`` needs ``LEAST`` documents with both, so terms and entities of fewer drop out; a
share of ``THRESHOLD`` needs p(e|t) >= p(e)^(1 - THRESHOLD), and no more than all documents with e hold both, so only
terms in at most n(e)^THRESHOLD N^(1 - THRESHOLD) documents can reach it; terms above the largest such bound are
dropped before rows are shuffled, the ``FREQUENT`` commonest of them by a broadcast; and entities of the
same documents, which have the same shares, are counted as one (sets of documents are told by 64-bit hashes). A document
still meets each of its shared entities with each of its shared terms, which grows with that document alone.
Words of all texts meet the disclosing terms by a broadcast of these while there are ``SENT`` of them at most, and by a
shuffle of the words above that. Texts are not shuffled.

Defined results: null text is empty and has no spans. Patterns are matched from the left without overlap
within a kind; a match that fails its test is dropped and not tried again. Positions count code
points. Rows that repeat are documents of their own. An empty table gives no rows. Very long texts are read whole, and
the work on one grows with its length. Columns beyond the two named ones are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import written

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
THRESHOLD = 0.8
REMOVE = 0.95
#: p(e|t) is at least the estimate with a confidence of 0.9.
Z = 1.2816
#: The least p(e|t) of a term that discloses e.
LIKELY = 0.5
FREQUENT = 1 << 13
SENT = 1 << 20

# The look-behinds start a match only at the start of a run, or where the last match ended. A match
# that could start later in the run could start there too, and long runs are read once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these has no match of the kind.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
_WORDS = r"\p{L}{4,}"
_SPAN = "array<struct<start:int,end:int,value:string>>"


_PIECES = 256


def _once(values: Column, made) -> Column:
    """``made`` of an array that is worked out once, however often ``made`` names it."""
    return F.flatten(F.transform(F.array(values), made))


def _running(sizes: Column) -> Column:
    """Running sums of an array: in each step every number gains the one 1, 2, 4, ... places before it."""

    def step(sums: Column, k: Column) -> Column:
        back = F.pow(F.lit(2.0), k).cast("int")
        moved = F.concat(F.array_repeat(F.lit(0), back), F.slice(sums, F.lit(1), F.size(sums) - back))
        return F.zip_with(sums, moved, lambda x, y: x + y)

    steps = F.ceil(F.log2(F.size(sizes).cast("double"))).cast("int")
    return F.when(F.size(sizes) < 2, sizes).otherwise(F.aggregate(F.sequence(F.lit(0), steps - 1), sizes, step))


def spans_of(text: Column, pattern: str | Column) -> Column:
    """Start, end and value of every match, in order, as an array.

    The text is cut once into gaps and matches, and ends are running sums of their lengths, so the work on a text with
    very many matches grows like their number and its logarithm.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern

    def placed(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        sizes = F.zip_with(gaps, hits, lambda gap, hit: F.length(gap) + F.length(hit))
        return F.zip_with(
            _once(sizes, _running), hits,
            lambda end, hit: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("value")),
        )

    return _once(F.regexp_extract_all(text, pattern, F.lit(0)), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    turned = F.reverse(_digits(value))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(turned, i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.when(F.length(_digits(value)).between(12, 19), _luhn(value)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _passing(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda span: _passes(kind, span["value"]))


def base_spans(text: Column) -> dict[str, Column]:
    """For each kind the array of its passing matches."""
    return {
        kind: F.when(
            text.rlike(NEEDS[kind]),
            _passing(kind, spans_of(text, PATTERNS[kind])),
        ).otherwise(F.expr(f"cast(array() as {_SPAN})"))
        for kind in KINDS
    }


def _labelled(spans: Column, kind: str, order: int) -> Column:
    return F.transform(
        spans,
        lambda span: F.struct(
            span["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"),
            span["end"].alias("end"), span["value"].alias("value"),
        ),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _found(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Every document with its text and its base spans."""
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    kinds = texts.select("id", "text", *[spans.alias(kind) for kind, spans in base_spans(F.col("text")).items()])
    base = F.array_sort(F.concat(*[_labelled(F.col(kind), kind, i) for i, kind in enumerate(KINDS)]))
    rows = kinds.select(
        "id", "text", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS], base.alias("base")
    )
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "personal", "zstd")


def _entity(kind: Column, value: Column) -> Column:
    plain = F.when(kind.isin("card", "phone"), _digits(value)).otherwise(F.lower(value))
    return F.concat_ws(":", kind, plain)


def _terms(found: DataFrame) -> DataFrame:
    """``(row, term)``: the distinct words of whole texts."""
    words = F.transform(F.regexp_extract_all("text", F.lit(_WORDS), F.lit(0)), F.lower)
    return found.select("row", F.explode(F.array_distinct(words)).alias("term"))


def _lower(both: Column, of: Column) -> Column:
    """Lower end of the Wilson interval of ``both`` out of ``of``."""
    p, z2 = both / of, Z * Z
    return (p + z2 / (2 * of) - Z * F.sqrt(p * (1 - p) / of + z2 / (4 * of * of))) / (1 + z2 / of)


def _most(with_entity: Column, documents: int) -> Column:
    """A term in more documents than this cannot disclose the entity (a little is added for rounding)."""
    return F.pow(with_entity, F.lit(THRESHOLD)) * documents ** (1 - THRESHOLD) * (1 + 1e-9)


def _least() -> int:
    """The fewest documents with both that can make an entity ``LIKELY``."""
    least = 1
    while least / (least + Z * Z) < LIKELY:
        least += 1
    return least


LEAST = _least()


def disclosures(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(term, share)`` of the terms that disclose an entity, with the largest share, and the
    commonest terms, which disclose none."""
    values = F.array_distinct(F.transform("base", lambda s: _entity(s["kind"], s["value"])))
    held = written(found.where(F.size("base") > 0).select("row", F.explode(values).alias("entity")), "held")
    entities = held.groupBy("entity").agg(
        F.count("*").alias("with_entity"), F.min("row").alias("first"), F.bit_xor(F.xxhash64("row")).alias("rows")
    )
    documents = found.count()
    entities = written(entities.where(F.col("with_entity").between(LEAST, documents - 1)), "entities")
    limit = entities.agg(F.max(_most(F.col("with_entity"), documents))).first()[0] or 0.0
    counts = written(_terms(found).groupBy("term").agg(F.count("*").alias("with_term")), "terms")
    frequent = counts.where(F.col("with_term") > limit).orderBy(F.desc("with_term"), "term").limit(FREQUENT)
    frequent = written(frequent.select("term"), "frequent")
    rare = counts.where(F.col("with_term").between(LEAST, limit))
    # entities of the same documents are one class
    classes = held.join(entities, "entity").groupBy("row", "with_entity", "first", "rows").agg(F.lit(1).alias("one"))
    terms = _terms(found.where(F.size("base") > 0)).join(F.broadcast(frequent), "term", "left_anti").join(rare, "term")
    together = (
        classes.join(terms, "row").where(F.col("with_term") <= _most(F.col("with_entity"), documents))
        .groupBy("with_entity", "first", "rows", "term", "with_term").agg(F.count("*").alias("both"))
    )
    given = _lower(F.col("both"), F.col("with_term"))
    pmi = F.log2(given * documents / F.col("with_entity"))
    information = F.log2(documents / F.col("with_entity"))
    shares = (
        together.where(given >= LIKELY).select("term", (pmi / information).alias("share"))
        .where(F.col("share") >= THRESHOLD)
        .groupBy("term").agg(F.max("share").alias("share"))
    )
    return written(shares, "disclosures"), frequent


def _marks(found: DataFrame, shares: DataFrame, frequent: DataFrame) -> DataFrame:
    """``(row, hits, full)``: the spans of disclosing terms that touch no base span, and the terms that disclose all."""
    words = found.select("row", F.inline(spans_of(F.col("text"), _WORDS)))
    words = words.withColumn("term", F.lower("value"))
    if shares.count() <= SENT:
        words = words.join(F.broadcast(shares), "term")
    else:
        words = words.join(F.broadcast(frequent), "term", "left_anti").join(shares, "term")
    base = found.select("row", F.inline("base")).select(
        "row", "start", "end", F.lit(None).alias("value"), F.lit(None).alias("term"), F.lit(None).alias("share")
    )
    both = words.select("row", "start", "end", "value", "term", "share").union(base)
    is_base = F.col("term").isNull()
    so_far = Window.partitionBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind, ahead = so_far.orderBy("start", F.desc(is_base)), so_far.orderBy(F.desc("start"), F.desc(is_base))
    reach = F.coalesce(F.max(F.when(is_base, F.col("end"))).over(behind), F.lit(0))
    first = F.coalesce(F.min(F.when(is_base, F.col("start"))).over(ahead), F.col("end"))
    apart = both.select("*", reach.alias("reach"), first.alias("first")).where(~is_base)
    apart = apart.where((F.col("reach") <= F.col("start")) & (F.col("first") >= F.col("end")))
    return apart.groupBy("row").agg(
        F.collect_list(F.struct("start", "end", "value")).alias("hits"),
        F.collect_set(F.when(F.col("share") >= REMOVE, F.col("term"))).alias("full"),
    )


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``,
    ``spans``, and for the sanitiser ``text`` and ``found`` (all spans)."""
    found = _found(docs, id_column, text_column)
    shares, frequent = disclosures(found)
    # a disclosing term is marked wherever it stands
    rows = found.join(written(_marks(found, shares, frequent), "marks"), "row", "left")
    hits = F.coalesce("hits", F.expr(f"cast(array() as {_SPAN})"))
    spans = F.array_sort(F.concat("base", _labelled(hits, TERM, len(KINDS))))
    return rows.withColumn("found", spans).select(
        F.col("id").alias(id_column),
        *[f"n_{kind}" for kind in KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        "text",
        "found",
        F.coalesce("full", F.expr("cast(array() as array<string>)")).alias("full"),
    )


def sanitised(found: DataFrame) -> DataFrame:
    """Rows of ``personal_data`` with base spans as spans' kinds in brackets, terms as ``[TERM]``, and terms
    that disclose everything removed. Null where the text stays as it is."""

    def run(done: Column, i: Column) -> Column:
        """The next run of spans, out of the part of the text that they lie in."""
        spans = F.slice("found", i, F.lit(_PIECES))
        first = done["at"]
        part = F.substring(F.col("text"), first + 1, F.greatest(F.lit(0), F.array_max(F.transform(spans, lambda s: s["end"])) - first))

        def within(part: Column) -> Column:
            def step(done: Column, span: Column) -> Column:
                label = F.when(span["kind"] != TERM, F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
                label = label.when(F.array_contains("full", F.lower(span["value"])), F.lit("")).otherwise("[TERM]")
                gap = F.substring(part, done["at"] - first + 1, span["start"] - done["at"])
                return F.when(
                    span["start"] >= done["at"],
                    F.struct(span["end"].alias("at"), F.concat(done["out"], gap, label).alias("out")),
                ).otherwise(F.struct(F.greatest(done["at"], span["end"]).alias("at"), done["out"].alias("out")))

            return F.aggregate(spans, F.struct(first.alias("at"), F.lit("").alias("out")), step)

        end = F.transform(F.array(part), within)[0]
        return F.struct(end["at"].alias("at"), F.concat(done["parts"], F.array(end["out"])).alias("parts"))

    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))
    rest = F.aggregate(
        F.sequence(F.lit(1), F.size("found"), F.lit(_PIECES)), zero, run,
        lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(F.col("text"), done["at"] + 1, F.length("text"))),
    )
    return found.withColumn("sanitised", F.when(F.size("found") > 0, rest))
