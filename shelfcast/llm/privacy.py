"""PII by information-theoretic sanitisation, in DataFrame functions only.

Base detection finds e-mail and IP addresses, card and phone numbers by pattern and check. Beyond these, words can
give a protected value away. Co-occurrence over the whole corpus estimates how strongly: of the rows that hold a term,
the share in which it stands beside the value, P(value | term), and the bits it adds over the value's own share,
log2 P(value | term) / P(value). A term is disclosed if it stands beside a value in at least MIN_CONTEXTS different
contexts (copies of a passage are one), with a share of at least MIN_SHARE and MIN_BITS bits; every occurrence of it
is a span: ``remove`` from a share of REMOVE_SHARE on, ``generalise`` below.

Occurrences of candidate terms are counted in one pass over the words of all rows. Before they are shuffled, words
are met with the candidates' hash buckets, of which there are at most BUCKETS, so that table may be broadcast.

Patterns are written without backtracking: a run is only entered at its start, so long texts take linear time.

Defined results: a null text is empty; spans count code points, end exclusive; rows that repeat have a result each
and count each; null ids are kept; other columns are ignored or kept as they are; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import fresh, stored, table

#: What is searched for, in order; each pattern gives the leftmost non-overlapping matches of its rule. Rules:
#: e-mail ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``, ip ``[0-9]+(\.[0-9]+)`` with three such parts, card
#: ``[0-9]([\x20-]?[0-9])+`` of 13 to 19 digits, phone ``\+[0-9][\x20().0-9-]+[0-9]``.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
#: A text without this cannot match.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
LABELS = {k: f"[{k.upper()}]" for k in KINDS} | {"remove": "", "generalise": "[TERM]"}
CONTEXT_CHARS = 60
MIN_CONTEXTS = 3
MIN_SHARE = 0.5
MIN_BITS = 3.0
REMOVE_SHARE = 0.9
TERM_CHARS = 3
BUCKETS = 1 << 18
WORD = r"[^\p{L}\p{N}]+"
SPAN = "struct<kind: string, start: bigint, end: bigint>"


def _matches(text: F.Column, pattern: F.Column) -> F.Column:
    """array<struct<start, end, value>> of the matches, from the lengths of what lies between and of what matched."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(
        F.lit(0).cast("bigint").alias("at"),
        F.array().cast("array<struct<start: bigint, end: bigint, value: string>>").alias("out"),
    )

    def step(acc: F.Column, pair: F.Column) -> F.Column:
        first = acc["at"] + F.length(pair["between"])
        last = first + F.length(pair["found"])
        return F.struct(
            last.cast("bigint").alias("at"),
            F.array_append(acc["out"], F.struct(
                first.cast("bigint").alias("start"), last.cast("bigint").alias("end"), pair["found"].alias("value")
            )).alias("out"),
        )

    pairs = F.arrays_zip(found.alias("found"), between.alias("between"))
    pairs = F.filter(pairs, lambda p: p["found"].isNotNull())
    return F.when(F.size(found) > 0, F.aggregate(pairs, start, step)["out"])


def _luhn(value: F.Column) -> F.Column:
    digits = F.reverse(F.regexp_replace(value, "[^0-9]", ""))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + F.when(
            i % 2 == 0,
            F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                         F.substring(digits, i, F.lit(1)).cast("int") + 1),
        ).otherwise(F.substring(digits, i, F.lit(1)).cast("int")),
    )
    return total % 10 == 0


def _valid(kind: str, value: F.Column) -> F.Column:
    if kind == "ip":
        def small(part: F.Column) -> F.Column:
            digits = F.ltrim(part, F.lit("0"))
            return F.when(F.length(digits) <= 3, F.concat(F.lit("0"), digits).cast("int") <= 255).otherwise(False)

        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def base_spans(documents: DataFrame, text_column: str, name: str) -> DataFrame:
    """The frame with a column ``name``: array of (kind, start, end, value), by kind as listed, then start."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    found, columns = documents, []
    for kind, pattern in PATTERNS.items():
        columns.append(fresh(found, f"{name}_{kind}"))
        some = _matches(text, F.lit(pattern))
        if kind in NEEDS:
            some = F.when(F.contains(text, F.lit(NEEDS[kind])), some)
        found = found.withColumn(columns[-1], some)

    def of_kind(kind: str, column: str) -> F.Column:
        return F.transform(
            F.filter(F.col(column), lambda m: _valid(kind, m["value"])),
            lambda m: F.struct(
                F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")
            ),
        )

    parts = [of_kind(kind, column) for kind, column in zip(KINDS, columns)]
    empty = F.array().cast("array<struct<kind: string, start: bigint, end: bigint, value: string>>")
    return found.withColumn(name, F.concat(*[F.coalesce(p, empty) for p in parts])).drop(*columns)


def _terms(text: F.Column) -> F.Column:
    return F.filter(F.split(F.lower(text), WORD), lambda w: F.length(w) >= TERM_CHARS)


def _contexts(text: F.Column, spans: F.Column) -> F.Column:
    """array<struct<value, terms>>: the whole words within CONTEXT_CHARS characters on both sides of each span."""

    def around(s: F.Column) -> F.Column:
        before = F.substring(text, F.greatest(s["start"] - CONTEXT_CHARS + 1, F.lit(1)).cast("int"),
                             F.least(s["start"], F.lit(CONTEXT_CHARS)).cast("int"))
        before = F.when(s["start"] > CONTEXT_CHARS, F.regexp_replace(before, r"^[\p{L}\p{N}]+", "")).otherwise(before)
        after = F.substring(text, (s["end"] + 1).cast("int"), F.lit(CONTEXT_CHARS))
        after = F.when(F.length(after) == CONTEXT_CHARS, F.regexp_replace(after, r"[\p{L}\p{N}]+$", "")).otherwise(after)
        return F.struct(
            s["value"].alias("value"), F.array_distinct(_terms(F.concat(before, F.lit(" "), after))).alias("terms")
        )

    return F.transform(spans, around)


def disclosed_terms(documents: DataFrame, text_column: str, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(term, share, bits) of the disclosed terms, and the terms (key, terms array) of each row that holds some."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = documents.select(*key, text.alias("t"))
    # Rows are numbered before they are exploded: in the same select each context would have a number.
    numbered = base_spans(rows, "t", "s").where(F.size("s") > 0).select(
        F.monotonically_increasing_id().alias("row"), F.array_distinct(_contexts(F.col("t"), F.col("s"))).alias("all")
    )
    seen = stored(
        numbered.select("row", F.explode("all").alias("c")).select("row", "c.value", "c.terms"), "privacy-contexts"
    )
    total = documents.agg(F.count(F.lit(1)).alias("total"))
    value_rows = seen.select("row", "value").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("value_rows"))
    pairs = seen.select("row", "value", F.xxhash64("terms").alias("context"), F.explode("terms").alias("term"))
    contexts = (
        pairs.select("value", "term", "context").distinct().groupBy("value", "term")
        .agg(F.count(F.lit(1)).alias("contexts")).where(F.col("contexts") >= MIN_CONTEXTS)
    )
    together = (
        pairs.select("row", "value", "term").distinct().groupBy("value", "term").agg(F.count(F.lit(1)).alias("together"))
    )
    # A term's rows in the corpus are no fewer than its rows beside any value: what cannot reach the share goes now.
    least_rows = pairs.select("row", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("least_rows"))
    candidates = stored(
        contexts.join(together, ["value", "term"]).join(value_rows, "value").join(least_rows, "term")
        .where(F.col("together") >= MIN_SHARE * F.col("least_rows")).drop("least_rows"),
        "privacy-candidates",
    )
    bucket = F.pmod(F.xxhash64("term"), F.lit(BUCKETS))
    buckets = candidates.select(bucket.alias("bucket")).distinct()  # at most BUCKETS rows
    words = stored(
        rows.select(*key, F.explode(F.array_distinct(_terms(F.col("t")))).alias("term"))
        .withColumn("bucket", bucket).join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket"),
        "privacy-words",
    )
    holders = words.join(candidates.select("term").distinct(), "term", "left_semi")
    counts = holders.groupBy("term").agg(F.count(F.lit(1)).alias("term_rows"))
    share = F.col("together") / F.col("term_rows")
    bits = F.log2(share * F.col("total") / F.col("value_rows"))
    terms = stored(
        candidates.join(counts, "term").join(F.broadcast(total), how="cross")  # one row
        .select("term", share.alias("share"), bits.alias("bits"))
        .where((F.col("share") >= MIN_SHARE) & (F.col("bits") >= MIN_BITS))
        .groupBy("term").agg(F.max("share").alias("share"), F.max("bits").alias("bits")),
        "privacy-terms",
    )
    held = stored(
        holders.join(terms, "term").groupBy(*key).agg(
            F.array_sort(F.collect_set(F.struct("term", (F.col("share") >= REMOVE_SHARE).alias("gone")))).alias("terms")
        ), "privacy-held",
    )
    return terms, held


def _term_spans(text: F.Column, terms: F.Column) -> F.Column:
    """Spans of kinds generalise and remove, of every occurrence of the row's disclosed terms."""
    names = F.transform(terms, lambda t: t["term"])
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.concat_ws("|", names), F.lit(r")(?![\p{L}\p{N}])"))
    gone = F.transform(F.filter(terms, lambda t: t["gone"]), lambda t: t["term"])
    return F.transform(
        _matches(text, pattern),
        lambda m: F.struct(
            F.when(F.array_contains(gone, F.lower(m["value"])), "remove").otherwise("generalise").alias("kind"),
            m["start"].alias("start"), m["end"].alias("end"),
        ),
    )


def find_personal(
    documents: DataFrame, text_column: str = "text", id_column: str = "doc_id", keep: list[str] | None = None,
    base: str = "base", added: str = "added",
) -> DataFrame:
    """The columns ``keep`` (none: all) and two of other names: ``base`` (kind, start, end, value) and ``added`` (kind,
    start, end) spans."""
    columns = keep if keep is not None else documents.columns
    # One struct holds what is kept, so the columns added here cannot clash with any of it.
    own = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col(f"`{id_column}`").alias("key_id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    ).withColumn("key_text", F.xxhash64("text"))
    _, held = disclosed_terms(own, "text", ["key_id", "key_text"])
    held = held.select(F.col("key_id").alias("h_id"), F.col("key_text").alias("h_text"), F.col("terms").alias("h_terms"))
    spans = base_spans(own, "text", "base")
    text = F.col("text")
    if text_column in columns:  # it need not travel twice
        spans, text = spans.drop("text"), F.coalesce(F.col("doc").getField(text_column).cast("string"), F.lit(""))
    joined = spans.join(held, F.col("key_id").eqNullSafe(F.col("h_id")) & (F.col("key_text") == F.col("h_text")), "left")
    more = F.when(F.col("h_terms").isNotNull(), _term_spans(text, F.col("h_terms")))
    empty = F.array().cast(f"array<{SPAN}>")
    return joined.select(
        *[F.col("doc").getField(c).alias(c) for c in columns],
        F.col("base").alias(base), F.coalesce(more, empty).alias(added),
    )


def redacted(text: F.Column, base: F.Column, added: F.Column) -> F.Column:
    """The text with every span replaced by its label; overlapping spans are one, labelled by the first."""
    plain = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    more = F.transform(added, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.array_sort(F.concat(plain, more))
    label = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: F.Column, s: F.Column) -> F.Column:
        piece = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.when(
            s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        ).otherwise(F.struct(
            s["end"].alias("at"), F.concat(acc["out"], F.array(piece, label[s["kind"]])).alias("out")
        ))

    def finish(acc: F.Column) -> F.Column:
        rest = F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(acc["out"], ""), rest)

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def _listed(spans: F.Column) -> F.Column:
    return F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))


def _count(kind: str) -> F.Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal(documents, keep=["doc_id"])
    base = F.array_join(_listed(F.col("base")), ",")
    order = F.array_sort(F.col("added"))  # by kind, then start
    every = F.array_join(F.concat(_listed(F.col("base")), _listed(order)), ",")
    return found.select(
        "doc_id",
        *[_count(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(base, 256).alias("base_sha256"), every.alias("spans"),
    )
