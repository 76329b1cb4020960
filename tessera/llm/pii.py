"""Personal data by weak supervision, in DataFrame functions only.

Four base kinds have fixed rules, and their matches always stay. Looser patterns propose more candidates: obfuscated
addresses, local phone numbers, long numbers, secrets. On every candidate five labelers vote yes, no or abstain: the
strict pattern, a structure check, a gazetteer, the words before it, and the character after it. Votes are counted by
pattern over all documents; from these counts, expectation-maximisation estimates for each kind how reliable each
labeler is, and a logistic span classifier is fitted to what it believes. Candidates the classifier accepts are added,
unless they overlap a base span or an earlier addition.

Only counts by kind and pattern of votes, of which there are at most 3 ** 5 a kind, reach the driver. Patterns are
written so that Java's matcher runs in linear time and without recursion on texts of any length, with the same
leftmost matches as the plain ones; each position comes from the lengths of the matches and the gaps between them. No
pattern bounds the length of a secret or of an address; top-level domains of over 24 letters only get a vote of no.

Nothing compares all matches of a text with each other or walks the text for each: positions and overlaps are running
sums and extremes over sorted spans, taken by blocks, and a text is cut at its spans by way of pieces of PIECE characters. Texts are matched once: what was found, and how
it was voted on, is cut off in the shared folder before the classifier is fitted.

Defined results. Null or empty text: no spans. Null ids and repeated rows: each row is searched. Empty table: no rows
and an unfitted classifier, which adds nothing. Other columns pass through, but for one of the name `into`, which is
replaced. Additions that overlap become one span, of the kind of the first, of those that begin together the longest.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.durable import checkpoint

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

#: Base patterns, each the same language as the plain one, guarded against restarts inside a run and possessive.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
NUMBER = r"(?<![0-9])[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Further candidates.
HIDDEN_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?i:at)[\])] ?[A-Za-z0-9-]++ ?(?:\.|[\[(](?i:dot)[\])]) ?[A-Za-z]{2,}+"
LOCAL_PHONE = r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
SECRET = r"(?i)(?<![a-z])(?:token|secret|api[_-]?key|password|passwd)\s?[=:]\s?\"?[a-z0-9_./+-]{8,}+\"?"

#: Gazetteers and cue words of the labelers.
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "it", "nl", "eu", "info", "biz")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "81", "82", "86", "91")
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65")
CUES = {
    "email": ("mail", "contact", "write to", "@"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "master", "payment", "pay"),
    "phone": ("phone", "tel", "call", "fax", "mobile"),
    "secret": ("auth", "login", "bearer", "credential", "key"),
}
DECOYS = ("version", "isbn", "order", "invoice", "serial", "page")
LABELERS = ("pattern", "structure", "gazetteer", "context", "boundary")
ACCEPT = 0.5
#: Characters of a text to a piece, and elements to a block of a running sum.
PIECE, BLOCK = 1024, 64

_SPAN = "struct<start:int,end:int,value:string>"
_FOUND = "struct<kind:string,start:int,end:int>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once, which a struct's fields in a projection are not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(values: Column, zero: int, op: Callable[[Column, Column], Column]) -> Column:
    """What `op`, which is associative, makes of all values before each, by blocks of BLOCK: a fold that gathered an
    array would copy it at every step."""
    over = lambda xs: F.aggregate(xs, F.lit(zero), lambda a, b: op(a, b))

    def blockwise(blocks: Column, whole: Column) -> Column:
        before = F.transform(whole, lambda _, j: over(F.slice(whole, F.lit(1), j)))
        return F.flatten(F.zip_with(blocks, before, lambda block, first: F.transform(block, lambda _, i: op(first, over(F.slice(block, F.lit(1), i))))))

    def cut_up(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda j: F.slice(v, j * BLOCK + 1, F.lit(BLOCK)))
        return let(blocks, lambda bs: let(F.transform(bs, over), lambda whole: blockwise(bs, whole)))

    return let(values, lambda v: F.when(F.size(v) > 0, cut_up(v)).otherwise(v))


def pieces_of(text: Column) -> Column:
    return F.when(F.length(text) <= PIECE, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from `start` up to `end` of a text, by its pieces."""
    first, last = F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
    head = lambda n: F.substring(F.coalesce(F.get(pieces, first), F.lit("")), start - first * PIECE + 1, n)
    whole = F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    tail = F.substring(F.coalesce(F.get(pieces, last), F.lit("")), F.lit(1), end - last * PIECE)
    return F.when(end <= start, "").when(first == last, head(end - start)).otherwise(F.concat(head(F.lit(PIECE)), whole, tail))


def spans_of(text: Column, pattern: str, needed: Column) -> Column:
    """The leftmost non-overlapping matches with their positions in code points."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    steps = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("value"), F.length(g).alias("gap"), F.length(m).alias("size")))
    span = lambda x, at: F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + x["size"]).alias("end"), x["value"].alias("value"))
    placed = lambda all_: F.zip_with(all_, scan(F.transform(all_, lambda x: x["gap"] + x["size"]), 0, lambda a, b: a + b), span)
    return F.when(needed, let(steps, placed)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def weigh(i: Column) -> Column:
        d = F.substring(number, -i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, 2 * d).otherwise(d)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda acc, i: acc + weigh(i))
    return F.when(F.length(number) > 0, total % 10 == 0).otherwise(False)


def is_card(value: Column) -> Column:
    return F.when(F.length(digits(value)).between(13, 19), luhn(digits(value))).otherwise(False)


def is_ip(value: Column) -> Column:
    def small(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+(?=.)", "")
        return F.when(F.length(plain) <= 3, plain.cast("int") <= 255).otherwise(False)

    return F.forall(F.split(value, r"\."), small)


def is_phone(value: Column) -> Column:
    return F.length(digits(value)).between(9, 15)


_ALWAYS = lambda value: F.lit(True)
#: Of each base kind: its pattern, a cheap test that a text may hold it, and the check on a match.
BASE: dict[str, tuple[str, Callable[[Column], Column], Callable[[Column], Column]]] = {
    "email": (EMAIL, lambda t: t.contains("@"), _ALWAYS),
    "ip": (IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), is_ip),
    "card": (NUMBER, lambda t: t.rlike("[0-9](?:[ -]?[0-9]){12}"), is_card),
    "phone": (PHONE, lambda t: t.rlike(r"\+[0-9]"), is_phone),
}


def _tagged(spans: Column, kind: str, strict: Callable[[Column], Column]) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), strict(s["value"]).alias("strict")))


def matches(text: Column) -> Column:
    """Base matches and further candidates: array<struct<kind, start, end, value, strict>>; strict marks base spans."""
    loose = lambda value: F.lit(False)
    base = [_tagged(spans_of(text, pattern, needed(text)), kind, strict) for kind, (pattern, needed, strict) in BASE.items()]
    more = [
        _tagged(spans_of(text, HIDDEN_EMAIL, text.rlike(r"[\[(](?i:at)[\])]")), "email", loose),
        _tagged(spans_of(text, LOCAL_PHONE, text.rlike(r"[0-9]{3}[ .-][0-9]{4}")), "phone", loose),
        _tagged(spans_of(text, SECRET, text.rlike("[=:]") & text.rlike("(?i)token|secret|api[_-]?key|passw")), "secret", loose),
    ]
    return F.concat(*base, *more)


def _starts(value: Column, prefixes: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (value.startswith(p) for p in prefixes))


def _any_in(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(w) for w in words))


def _by_kind(kind: Column, of: dict[str, Column]) -> Column:
    out = F.lit(0)
    for k, vote in of.items():
        out = F.when(kind == k, vote).otherwise(out)
    return out


def votes(pieces: Column, size: Column, span: Column) -> Column:
    """The labelers' votes on a candidate in a text of so many characters: 1, -1 or 0."""
    yes = lambda c: F.when(c, 1).otherwise(-1)
    kind, value = span["kind"], span["value"]
    number = digits(value)
    before = F.lower(cut(pieces, F.greatest(span["start"] - 40, F.lit(0)), span["start"]))
    after = cut(pieces, span["end"], F.least(span["end"] + 2, size))
    last_label = F.lower(F.regexp_extract(value, "(?<![A-Za-z0-9-])([A-Za-z0-9-]++)$", 1))
    structure = _by_kind(kind, {"email": yes(last_label.rlike("^[a-z]{2,24}$")), "ip": yes(is_ip(value)), "card": yes(is_card(value)), "phone": yes(is_phone(value)), "secret": yes(value.rlike("[0-9]") & (F.length(value) >= 24))})
    gazetteer = _by_kind(kind, {"email": yes(last_label.isin(*TOP_DOMAINS)), "ip": F.when(_starts(value, ("0.", "127.", "255.")), -1).otherwise(1), "card": yes(_starts(number, CARD_PREFIXES)), "phone": F.when(~value.startswith("+"), 0).otherwise(yes(_starts(number, CALLING_CODES))), "secret": yes(value.rlike("^(?i)(?:token|api[_-]?key|secret)"))})
    cue = _by_kind(kind, {k: F.when(_any_in(before, words), 1).otherwise(0) for k, words in CUES.items()})
    context = F.when(_any_in(before, DECOYS), -1).otherwise(cue)
    return F.struct(
        F.when(span["strict"], 1).otherwise(0).alias("pattern"),
        structure.alias("structure"),
        gazetteer.alias("gazetteer"),
        context.alias("context"),
        F.when(after.rlike("^(?:[A-Za-z0-9_]|[.-][0-9])"), -1).otherwise(1).alias("boundary"),
    )


def _believe(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Expectation-maximisation over counted patterns of votes: the chance of each pattern to be personal data.

    A labeler's votes are independent of the others' given the truth; it starts from the vote's majority."""
    belief = 1 / (1 + np.exp(-patterns.sum(axis=1).astype(float)))
    for _ in range(rounds):
        logit = np.log(((counts * belief).sum() + 1) / ((counts * (1 - belief)).sum() + 1)) + np.zeros(len(counts))
        for j in range(patterns.shape[1]):
            for vote in (-1, 0, 1):
                at = patterns[:, j] == vote
                given = [((counts * b)[at].sum() + 0.5) / ((counts * b).sum() + 1.5) for b in (belief, 1 - belief)]
                logit[at] += np.log(given[0] / given[1])
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - belief).max() < 1e-6:
            break
        belief = new
    return belief


def _classify(patterns: np.ndarray, counts: np.ndarray, belief: np.ndarray, l2: float = 0.1) -> np.ndarray:
    """Logistic weights of (constant, yes votes, no votes), fitted to the beliefs by Newton's method."""
    x = np.concatenate([np.ones((len(counts), 1)), patterns == 1, patterns == -1], axis=1).astype(float)
    scale = counts / counts.sum() * min(counts.sum(), 1000.0)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (scale * (p - belief)) + l2 * w
        hessian = (x * (scale * p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _voted(docs: DataFrame, text: Column, into: str) -> DataFrame:
    """`docs` with every match and its votes in `into`: array<struct<kind, start, end, strict, votes>>."""
    span = lambda b, s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["strict"].alias("strict"), votes(b["pieces"], b["size"], s).alias("votes"))
    held = F.struct(matches(text).alias("found"), pieces_of(text).alias("pieces"), F.length(text).alias("size"))
    return docs.withColumn(into, let(held, lambda b: F.transform(b["found"], lambda s: span(b, s))))


def _fit(voted: DataFrame, into: str) -> dict[str, np.ndarray]:
    spans = voted.select(F.explode(into).alias("span")).select(F.col("span.kind").alias("kind"), "span.votes.*")
    rows = sorted(tuple(r) for r in spans.groupBy("kind", *LABELERS).count().collect())
    model = {}
    for kind in KINDS:
        own = [r for r in rows if r[0] == kind]
        if own:
            patterns, counts = np.array([r[1:-1] for r in own]), np.array([r[-1] for r in own], dtype=float)
            model[kind] = _classify(patterns, counts, _believe(patterns, counts))
    return model


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def fit(docs: DataFrame, text_col: str = "text") -> dict[str, np.ndarray]:
    """The span classifier's weights of each kind that has candidates."""
    text = _text(text_col)
    return _fit(_voted(docs.select(text.alias("text")), F.col("text"), "__pii"), "__pii")


def accepted(vote: Column, kind: Column, model: dict[str, np.ndarray]) -> Column:
    """Whether the span classifier takes a candidate for personal data."""
    out = F.lit(False)
    for k, w in model.items():
        terms = [F.when(vote[name] == v, float(w[i])).otherwise(0.0) for v, base in ((1, 1), (-1, 1 + len(LABELERS))) for i, name in enumerate(LABELERS, base)]
        score = reduce(lambda a, b: a + b, terms, F.lit(float(w[0])))
        out = F.when(kind == k, score >= float(np.log(ACCEPT / (1 - ACCEPT)))).otherwise(out)
    return out


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


_FAR = (1 << 31) - 1


def _running(spans: Column, value: Callable[[Column], Column], zero: int, op: Callable[[Column, Column], Column]) -> Column:
    return scan(F.transform(spans, value), zero, op)


def _additions(base: Column, good: Column) -> Column:
    """Of the candidates that were accepted, those that overlap no base span, overlapping ones as one span."""
    mark = lambda spans, more: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), F.lit(more).alias("more"), s["kind"].alias("kind")))

    def clear(spans: Column) -> Column:
        ended = _running(spans, lambda s: F.when(s["more"], 0).otherwise(-s["back"]), 0, F.greatest)
        begun = F.reverse(_running(F.reverse(spans), lambda s: F.when(s["more"], _FAR).otherwise(s["start"]), _FAR, F.least))
        around = F.zip_with(F.zip_with(spans, ended, lambda s, e: F.struct(s.alias("s"), e.alias("ended"))), begun, lambda x, b: F.struct(x["s"].alias("s"), x["ended"].alias("ended"), b.alias("begun")))
        return F.transform(F.filter(around, lambda x: x["s"]["more"] & (x["ended"] <= x["s"]["start"]) & (-x["s"]["back"] <= x["begun"])), lambda x: x["s"])

    def joined(spans: Column) -> Column:
        before = F.zip_with(spans, _running(spans, lambda s: -s["back"], 0, F.greatest), lambda s, e: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), e.alias("before")))
        end = F.array_max(F.transform(spans, lambda s: -s["back"]))
        whole = lambda heads: F.transform(heads, lambda h, i: F.struct(h["kind"].alias("kind"), h["start"].alias("start"), F.coalesce(F.get(heads, i + 1)["before"], end).alias("end")))
        return let(F.filter(before, lambda x: x["before"] <= x["start"]), whole)

    return let(let(F.array_sort(F.concat(mark(base, False), mark(good, True))), clear), joined)


def find_pii(docs: DataFrame, model: dict[str, np.ndarray] | None = None, text_col: str = "text", into: str = "pii", keep_text: bool = True) -> DataFrame:
    """`docs` with a struct column `into`: base and spans, arrays of (kind, start, end) by kind, then start."""
    voted = _voted(docs, _text(text_col), into)
    if not keep_text:
        voted = voted.drop(text_col)
    if model is None:
        voted = checkpoint(voted)  # read by the fit and by what follows it
        model = _fit(voted, into)
    plain = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    base = F.transform(F.filter(into, lambda s: s["strict"]), plain)
    good = F.transform(F.filter(into, lambda s: ~s["strict"] & accepted(s["votes"], s["kind"], model)), plain)
    with_added = lambda b: F.struct(b["base"].alias("base"), F.when(F.size(b["good"]) > 0, _additions(b["base"], b["good"])).otherwise(b["good"]).alias("added"))
    by_kind = lambda spans: F.concat(*(F.array_sort(of_kind(spans, k)) for k in KINDS))
    whole = lambda b: F.struct(b["base"].alias("base"), let(F.concat(b["base"], b["added"]), by_kind).alias("spans"))
    return voted.withColumn(into, let(let(F.struct(base.alias("base"), good.alias("good")), with_added), whole))


def redact(docs: DataFrame, model: dict[str, np.ndarray] | None = None, text_col: str = "text") -> DataFrame:
    """`docs` with every span of its text replaced by its kind in angle brackets; overlapping spans are joined."""
    into, more = "__pii", "__pieces"
    text = F.col(text_col).cast("string")
    found = find_pii(docs, model, text_col, into).withColumn(more, F.when(F.size(F.col(into)["spans"]) > 0, pieces_of(text)))
    ordered = F.array_sort(F.transform(F.col(into)["spans"], lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def rewritten(spans: Column) -> Column:
        part = lambda s, at: F.when(s["start"] >= at, F.concat(cut(F.col(more), at, s["start"]), F.lit("<"), s["kind"], F.lit(">"))).otherwise("")
        parts = F.zip_with(spans, _running(spans, lambda s: s["end"], 0, F.greatest), part)
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(parts, ""), cut(F.col(more), last, F.length(text)))

    return found.withColumn(text_col, F.when(F.col(more).isNotNull(), let(ordered, rewritten)).otherwise(F.col(text_col))).drop(into, more)


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: every document's counts of base spans, their digest, and all spans."""
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), keep_text=False)
    base, spans = F.col("pii.base"), F.col("pii.spans")
    counts = [F.size(of_kind(base, k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(_digest(base).cast("binary"), 256).alias("base_sha256"), _digest(spans).alias("spans"))
