"""Personal data by base rules and by weak supervision, in DataFrame functions only.

Base spans are those of four fixed patterns with their checks. The method adds spans: every number-like
or address-like expression is a candidate, and regex, gazetteer and context labelers vote on it (for,
against, or not at all). Expectation-maximisation over the counts of all vote patterns in the corpus
estimates how reliable each labeler is and how likely a candidate is personal data; a naive Bayes span
classifier is trained on these likelihoods and on features of the span and decides alone.

Votes and features have few values, so what is counted over the corpus, and what is fitted on the
driver, has a bounded number of rows. Texts are scanned where they lie; there is no shuffle of texts.

A number of a card's length whose check digit fails is no card unless a word before it says so.

To find places, each match is put between marks and the text is cut at the marks, so pieces are in turn
outside and inside of matches; a text's own marks are first replaced by another control character,
which no pattern can match either. Patterns have possessive repeats where these cannot change a match.
Places are running sums of the pieces' lengths, made in chunks of the square root of their number, overlaps are
found by bisection, and texts are rebuilt from blocks, so a text with n spans takes n ** 1.5 short steps at most.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.tables import documents

KINDS = ("email", "ip", "card", "phone")
_MARK, _OTHER = "\x01", "\x02"

# The base patterns, in possessive form. A match can only begin where the run of its first
# characters begins or where the match before it ends (\G), so long runs are scanned once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

# Candidates of the method: addresses of eight groups, numbers of 7 to 24 characters with signs in them, and spelled-out addresses.
CANDIDATE = (
    r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
    r"|(?<![0-9A-Za-z.@+-])\(?[0-9][0-9().\x20/-]{5,22}[0-9](?![0-9A-Za-z])"
    r"|(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9.-]*[A-Za-z0-9]"
)
CONTEXT_CHARS = 40
BLOCK_CHARS = 1024
# Words that speak for or against personal data before a number, and issuer prefixes.
FOR_WORDS = "tel|phone|mobile|call|fax|contact|whatsapp|sms|card|visa|mastercard|account|konto|iban|ssn|telefon|handy|téléphone|carte|teléfono|móvil|tarjeta|cuenta|mail"
AGAINST_WORDS = "version|page|chapter|figure|table|section|isbn|issn|doi|year|seite|kapitel|página|capítulo|license|total|price|eur|usd"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
EM_ROUNDS = 50
PRIOR = 0.5  # share of candidates taken for personal data before any vote


def _cut(text: Column, pattern: str) -> Column:
    marked = F.regexp_replace(F.replace(text, F.lit(_MARK), F.lit(_OTHER)), F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}"))
    return F.split(marked, _MARK, -1)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once, also where lambdas use it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or another associative ``add``) of an array of integers, each with its own value in.

    In chunks of the square root of the array's size: within chunks, then over the chunks' last ones.
    """
    def scanned(xs: Column) -> Column:
        empty = F.array().cast("array<int>")
        more = lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) == 0, x).otherwise(add(F.element_at(acc, -1), x))))
        return F.when(F.size(xs) > 0, F.aggregate(xs, empty, more)).otherwise(empty)

    def by_chunks(xs: Column) -> Column:
        step = (F.floor(F.sqrt(F.size(xs))) + 1).cast("int")
        begins = F.sequence(F.lit(1), F.size(xs), step)
        return _let(F.transform(begins, lambda b: scanned(F.slice(xs, b, step))), with_totals)

    def with_totals(chunks: Column) -> Column:
        totals = scanned(F.transform(chunks, lambda c: F.element_at(c, -1)))
        carried = lambda before: F.flatten(F.transform(
            chunks, lambda c, i: F.when(i == 0, c).otherwise(F.transform(c, lambda x: add(F.get(before, i - 1), x)))))
        return _let(totals, carried)

    return _let(values, lambda xs: F.when(F.size(xs) > 0, by_chunks(xs)).otherwise(F.array().cast("array<int>")))


def _matched(text: Column, pattern: str, made: Callable[[Column, Column, Column], Column]) -> Column:
    """``made(body, start, before)`` of every match, before it the piece of text between it and the match before."""
    def at_matches(pieces: Column) -> Column:
        ends = _running(F.transform(pieces, F.length), lambda a, b: a + b)
        odd = F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2))
        return _let(ends, lambda e: F.transform(odd, lambda i: made(F.get(pieces, i), F.get(e, i - 1), F.get(pieces, i - 1))))

    return _let(_cut(text, pattern), lambda pieces: F.when(F.size(pieces) > 2, at_matches(pieces)))


def _spans(text: Column, pattern: str, valid: Callable[[Column], Column], needs: str | None) -> Column:
    """Places of the valid matches; ends are exclusive, both count code points."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    span = lambda body, start, _: F.when(valid(body), F.struct(start.alias("start"), (start + F.length(body)).alias("end")))
    has = F.instr(text, needs) > 0 if needs else text.rlike("[0-9]")
    return F.when(has, F.coalesce(F.filter(_matched(text, pattern, span), F.isnotnull), none)).otherwise(none)


def _digits(piece: Column) -> Column:
    return F.regexp_replace(piece, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)

    def add(acc: Column, c: Column) -> Column:
        d = c.cast("int")
        return F.struct(
            (acc["sum"] + F.when(acc["odd"], doubled(d)).otherwise(d)).alias("sum"), (~acc["odd"]).alias("odd"))

    zero = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    return F.aggregate(F.split(F.reverse(digits), ""), zero, add, lambda acc: acc["sum"] % 10 == 0)


def _small_parts(piece: Column) -> Column:
    """Every number is at most 255, however many zeros stand before it."""
    return ~piece.rlike(r"(?:^|\.)0*(?:[1-9][0-9]{3,}|2[6-9][0-9]|25[6-9]|[3-9][0-9]{2})(?:\.|$)")


def _valid_card(piece: Column) -> Column:
    size = F.length(_digits(piece))
    return F.when(size.between(13, 19), _luhn(_digits(piece))).otherwise(False)


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda piece: F.lit(True),
    "ip": _small_parts,
    "card": _valid_card,
    "phone": lambda piece: F.length(_digits(piece)).between(9, 15),
}


def base_spans(text: Column) -> dict[str, Column]:
    return {kind: _spans(text, PATTERNS[kind], VALID[kind], NEEDS[kind]) for kind in KINDS}


def candidates(text: Column) -> Column:
    """Candidates with their place, their letters and what stands before them."""
    none = F.array().cast("array<struct<start:int,end:int,body:string,before:string>>")
    made = lambda body, start, before: F.struct(
        start.alias("start"), (start + F.length(body)).alias("end"), body.alias("body"),
        F.lower(F.substring(before, -CONTEXT_CHARS, CONTEXT_CHARS)).alias("before"))
    has = text.rlike("[0-9]") | text.rlike(r"[(\[]at[)\]]")
    return F.when(has, F.coalesce(_matched(text, CANDIDATE, made), none)).otherwise(none)


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, 1)
    return (vote if no is None else vote.when(no, -1)).otherwise(0)


def _named(before: Column) -> Column:
    return before.rlike(f"(^|[^\\p{{L}}])({FOR_WORDS})[^\\p{{L}}]")


def _may_be(body: Column, before: Column) -> Column:
    """False for what has a card's length, fails its check digit and is not named before."""
    digits = _digits(body)
    failed = F.length(digits).between(13, 19) & ~body.contains(":") & ~_luhn(digits)
    return ~failed | _named(before)


def labelers(body: Column, before: Column) -> dict[str, Column]:
    """Votes: 1 for personal data, -1 against, 0 none."""
    digits = _digits(body)
    size = F.length(digits)
    return {
        "shape": _vote(body.rlike(r"^\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$") | body.rlike(r"[(\[]at[)\]]") | body.contains(":"), size.between(1, 8)),
        "length": _vote(body.rlike("^[0-9]{13,19}$") | body.rlike("^[0-9]{4}([ -])[0-9]{4}\\1[0-9]{4}\\1[0-9]{1,7}$"), size > 19),
        "date": _vote(F.lit(False), body.rlike(r"^[0-9]{4}[-/.][0-9]{2}[-/.][0-9]{2}$|^[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4}$|^[0-9.]+$")),
        "checksum": _vote(size.between(13, 19) & _luhn(digits), (size >= 13) & ~body.contains(":")),
        "issuer": _vote((size >= 13) & digits.rlike(ISSUERS), digits.rlike("^0{4}")),
        "for": _vote(_named(before)),
        "against": _vote(F.lit(False), before.rlike(f"(^|[^\\p{{L}}])({AGAINST_WORDS})[^\\p{{L}}]|[$€#]\\s?$")),
    }


def features(body: Column, before: Column) -> dict[str, Column]:
    """Features of a span, each with few values."""
    size = F.length(_digits(body))
    return {
        "digits": F.when(size < 7, "0").when(size < 9, "7").when(size < 12, "9").when(size < 13, "12").when(size < 16, "13").when(size == 16, "16").otherwise("17"),
        "signs": F.concat(*[F.when(body.contains(s), s).otherwise("") for s in ("(", ".", "-", "/", " ", "at", ":")]),
        "opens": F.when(before.rlike(r"\p{L}\s$"), "word").when(before.rlike(r"[:=]\s?$"), "label").when(before.rlike(r"\p{Nd}\W*$"), "number").otherwise("else"),
        # Runs of digits and of letters as one sign each, so there are few beginnings.
        "group": F.regexp_extract(F.regexp_replace(F.regexp_replace(body, r"[^0-9().\x20/-]+", "a"), "[0-9]+", "9"), "^.{0,6}", 0),
    }


LABELERS = ("shape", "length", "date", "checksum", "issuer", "for", "against")
FEATURES = ("digits", "signs", "opens", "group")


def reliabilities(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[list[float], dict]:
    """EM over vote patterns and their counts: each pattern's likelihood, and each labeler's vote rates.

    Starts from the majority of the votes. A labeler's rate of a vote is smoothed by one count, so none
    becomes certain; with no candidates the result is empty.
    """
    share, likely = PRIOR, []
    for votes, _ in patterns:
        lead = sum(votes)
        likely.append(0.9 if lead > 0 else 0.1 if lead < 0 else 0.5)
    rates: dict = {}
    for _ in range(EM_ROUNDS):
        total = [1.0, 1.0]
        counts = [[{-1: 1.0, 0: 1.0, 1: 1.0} for _ in LABELERS] for _ in (0, 1)]
        for (votes, n), p in zip(patterns, likely):
            for side, weight in ((1, n * p), (0, n * (1 - p))):
                total[side] += weight
                for k, v in enumerate(votes):
                    counts[side][k][v] += weight
        share = total[1] / sum(total)
        rates = {side: [{v: c / sum(t.values()) for v, c in t.items()} for t in counts[side]] for side in (0, 1)}
        likely = []
        for votes, _ in patterns:
            # A labeler that abstains says nothing.
            odds = math.log(share / (1 - share)) + sum(
                math.log(rates[1][k][v] / rates[0][k][v]) for k, v in enumerate(votes) if v)
            likely.append(1 / (1 + math.exp(-max(-40.0, min(40.0, odds)))))
    return likely, rates


def fit(docs: DataFrame) -> dict:
    """The span classifier: log odds of each feature value, from all candidates of ``docs`` (text)."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select(F.explode(candidates(text)).alias("c"))
    votes = [v.cast("int").alias(f"v_{n}") for n, v in labelers(F.col("c.body"), F.col("c.before")).items()]
    traits = [v.alias(f"f_{n}") for n, v in features(F.col("c.body"), F.col("c.before")).items()]
    counted = found.select(*votes, *traits).groupBy(*[f"v_{n}" for n in LABELERS], *[f"f_{n}" for n in FEATURES]).count()
    rows = counted.collect()
    patterns: dict[tuple, int] = {}
    for r in rows:
        key = tuple(r[f"v_{n}"] for n in LABELERS)
        patterns[key] = patterns.get(key, 0) + r["count"]
    order = sorted(patterns)
    likely, _ = reliabilities([(p, patterns[p]) for p in order])
    by_pattern = dict(zip(order, likely))
    sums: dict = {n: {} for n in FEATURES}
    total = [1.0, 1.0]
    for r in rows:
        p = by_pattern[tuple(r[f"v_{n}"] for n in LABELERS)]
        for side, weight in ((1, r["count"] * p), (0, r["count"] * (1 - p))):
            total[side] += weight
            for n in FEATURES:
                sums[n].setdefault(r[f"f_{n}"], [0.5, 0.5])[side] += weight
    odds = {n: {v: math.log(c[1] / total[1]) - math.log(c[0] / total[0]) for v, c in sums[n].items()} for n in FEATURES}
    return {"prior": math.log(total[1] / total[0]), "odds": odds}


def _log_odds(model: dict, body: Column, before: Column) -> Column:
    total = F.lit(float(model["prior"]))
    for name, value in features(body, before).items():
        table = model["odds"][name]
        if table:
            pairs = [F.lit(x) for pair in sorted(table.items()) for x in (pair[0], float(pair[1]))]
            total = total + F.coalesce(F.element_at(F.create_map(*pairs), value), F.lit(0.0))
    return total


def _reach(spans: Column) -> Column:
    """How far the spans up to each one reach; spans are sorted by start."""
    return _running(F.transform(spans, lambda s: s["end"]), F.greatest)


def _overlaps(spans: Column, reach: Column, start: Column, end: Column) -> Column:
    """Whether any of the sorted spans overlaps ``start..end``: of those that begin in front of ``end``, found by
    bisection, the farthest reaches beyond ``start``."""
    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        before = (acc["low"] < acc["high"]) & (F.get(spans, middle)["start"] < end)
        return F.struct(
            F.when(before, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(before, acc["high"]).otherwise(F.least(middle, acc["high"])).alias("high"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
    bounds = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))
    count = F.aggregate(steps, bounds, halve, lambda acc: acc["low"])
    return F.when(F.size(spans) == 0, F.lit(False)).otherwise(F.coalesce(F.get(reach, count - 1) > start, F.lit(False)))


def find(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``docs`` with one column of spans per kind (``email``, ``ip``, ``card``, ``phone``) and ``added``.

    Spans have ``start`` and an exclusive ``end`` in code points; ``added`` also has their ``kind`` and
    holds no span that overlaps a base span. A null or empty text has none. Other columns and repeated
    rows pass through; columns of these names are replaced.
    """
    model = model or fit(docs)
    text = F.coalesce("text", F.lit(""))
    others = [c for c in docs.columns if c not in (*KINDS, "added", "_found")]
    based = docs.select(*others, *[v.alias(k) for k, v in base_spans(text).items()], candidates(text).alias("_found"))
    base = F.array_sort(F.concat(*[F.col(k) for k in KINDS]))
    free = _let(base, lambda b: _let(_reach(b), lambda reach: F.filter("_found", lambda c: ~_overlaps(b, reach, c["start"], c["end"]))))
    sure = F.filter(free, lambda c: _may_be(c["body"], c["before"]) & (_log_odds(model, c["body"], c["before"]) >= 0))
    kind = lambda body: F.when(body.rlike(r"[(\[]at[)\]]"), "email").when(body.contains(":"), "ip").when(
        F.length(_digits(body)) >= 13, "card").otherwise("phone")
    added = F.transform(sure, lambda c: F.struct(kind(c["body"]).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return based.select(*others, *KINDS, F.when(F.size("_found") > 0, added).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias("added"))


def _listed(kinds) -> Column:
    return F.array_join(F.concat(*kinds), ",")


def _of_kind(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _added(kind: str) -> Column:
    of_kind = F.filter("added", lambda s: s["kind"] == kind)
    return F.transform(of_kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def _words(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in brackets; overlapping spans as one.

    Texts without spans, NULL ones too, and all other columns stay as they are, whatever their names.
    """
    columns = docs.columns
    # The row travels in one column, so that no name of it can meet one of those made here.
    found = find(docs.select("text", F.struct("*").alias("row")))
    kinded = [_of_kind(k, F.col(k)) for k in KINDS]
    extra = F.transform("added", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.array_sort(F.concat(*kinded, extra))
    marked = found.withColumn("_spans", spans)
    redacted = F.when(F.size("_spans") > 0, _redacted(F.col("text"), F.col("_spans"))).otherwise(F.col("text"))
    return marked.select(*[redacted.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in columns])


def _redacted(text: Column, spans: Column) -> Column:
    """The text with its sorted spans replaced, put together from blocks, as a place far in a text is long to walk to."""
    def part(blocks: Column, start: Column, end: Column) -> Column:
        low, high = F.floor(start / BLOCK_CHARS).cast("int"), F.floor((end - 1) / BLOCK_CHARS).cast("int")
        near = F.array_join(F.slice(blocks, low + 1, high - low + 1), "")
        return F.when(end > start, F.substring(near, start - low * BLOCK_CHARS + 1, end - start)).otherwise(F.lit(""))

    def pieces(blocks: Column, reach: Column) -> Column:
        # A span that begins where those before it have ended opens a new mark, with the text in front of it.
        def piece(s: Column, i: Column) -> Column:
            behind = F.when(i == 0, F.lit(0)).otherwise(F.get(reach, i - 1))
            mark = F.concat(part(blocks, behind, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.when(s["start"] >= behind, mark).otherwise(F.lit(""))

        return F.concat(F.array_join(F.transform(spans, piece), ""), part(blocks, F.element_at(reach, -1), F.length(text)))

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))
    return _let(cut, lambda blocks: _let(_reach(spans), lambda reach: pieces(blocks, reach)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(documents(spark, sf_dir))
    base = {k: _words(k, F.col(k)) for k in KINDS}
    whole = [_words(k, F.array_sort(F.concat(F.col(k), _added(k)))) for k in KINDS]
    n_base = sum((F.size(k) for k in KINDS), F.lit(0))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(base.values()).cast("binary"), 256).alias("base_sha256"), _listed(whole).alias("spans"),
        (n_base + F.size("added")).cast("long").alias("n_spans"), F.size("added").cast("long").alias("n_added"),
    )
