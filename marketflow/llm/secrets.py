"""Secrets in texts: three fixed patterns, and stretches of high entropy.  Column expressions only.

Entropy: candidates are maximal runs of one character class, as long as a window at least.  Stretches
that the allow-list names (placeholders, alphabets, long rows of digits or of one character) are cut out
of them, which suppresses the windows that overlap these and no others.  In what is left a window slides
by one character.  Its Shannon entropy comes from counts that change by one in and one out per step: with
S = sum of c*log2(c) over the counts c, the entropy is log2(w) - S/w.  Windows at or above the class's
threshold are joined into spans; spans inside a span of a fixed pattern are dropped.

A candidate is walked in pieces that overlap by a window less one character, and every count is taken
within one window, so a step costs the same wherever it is and however large the alphabet is: a run of
a million characters takes a thousand times as long as one of a thousand.  Lists of matches and spans grow
in blocks for the same reason.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns and shortest lengths of the three base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_START = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class CharClass:
    """Candidates of one character class: the window's width and the least entropy in bits."""

    name: str
    characters: str
    width: int
    least: float


#: Random hex digits have about 3.4 bits in 24 places, random base64 characters about 4.3; words
#: run together stay below 3.7.
CLASSES = (
    CharClass("hex", "0-9a-f", 24, 3.1),
    CharClass("upper hex", "0-9A-F", 24, 3.1),
    CharClass("base64", "A-Za-z0-9+/_=-", 24, 4.0),
)

#: Stretches that are no secret though they look random: placeholders, alphabets and digit rows, long
#: numbers, one character over and over.
ALLOWED = (
    r"(?i:example|changeme|placeholder|dummy|sample|your[_-])",
    r"(?i:abcdefghij|0123456789|1234567890|9876543210|qwertyuiop)",
    r"[0-9]{24,}",
    r"(.)\g{7,}",
)
#: Places of a candidate that are walked together, and list entries that are.
PIECE, BLOCK = 256, 64
#: Characters of a text's pieces when spans are cut out of it.
TEXT_PIECE = 4096

SPAN = "struct<begin:int,rank:int,kind:string,end:int,found:string>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _walk(items: Column, carry: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """What ``step(carry, item)`` puts out for all items in turn, as one array of ``kind``.

    ``step`` returns the next carry and an array.  An array that grows is copied at every step, so each
    block of items has one of its own, and these are put together at the end.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(state, item):
        after, out = step(state["carry"], item)
        return F.struct(after.alias("carry"), F.concat(state["out"], out).alias("out"))

    def block(state, part):
        inner = F.aggregate(part, F.struct(state["carry"].alias("carry"), none.alias("out")), one)
        return _let(
            inner,
            lambda r: F.struct(r["carry"].alias("carry"), F.concat(state["outs"], F.array(r["out"])).alias("outs")),
        )

    def blocks(every: Column) -> Column:
        last = F.floor((F.greatest(F.size(every), F.lit(1)) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(every, k * BLOCK + 1, F.lit(BLOCK)))

    start = F.struct(carry.alias("carry"), F.array().cast(f"array<array<{kind}>>").alias("outs"))
    return F.aggregate(_let(items, blocks), start, block, lambda s: F.flatten(s["outs"]))


def _hits(text: Column, pattern: str, wanted: Column, kind: str, least: int = 0) -> Column:
    """Spans (begin, rank, kind, end, found) of all matches, where ``wanted``; code points, end exclusive.

    Matches and the gaps between them are cut by the same pattern, so positions are sums of lengths.
    """
    rank = KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if least else found
    gaps = F.split(text, pattern, -1)
    steps = F.arrays_zip(found.alias("found"), values.alias("value"), F.slice(gaps, 1, F.size(found)).alias("gap"))
    none = F.array().cast(f"array<{SPAN}>")

    def step(at, x):
        begin = at + F.length(x["gap"])
        end = begin + F.length(x["found"])
        span = F.struct(
            begin.alias("begin"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
            end.alias("end"), x["found"].alias("found"),
        )
        return end, F.when(F.length(x["value"]) >= least, F.array(span)).otherwise(none)

    return F.when(wanted, _walk(steps, F.lit(0), step, SPAN)).otherwise(none)


def _rests(text: Column, pattern: str | None) -> Column:
    """(at, text) of what is left of a text between the matches of a pattern."""
    kind = "struct<at:int,text:string>"
    whole = F.array(F.struct(F.lit(0).alias("at"), text.alias("text"))).cast(f"array<{kind}>")
    if pattern is None:
        return whole
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("found"))

    def step(at, x):
        after = at + F.length(x["gap"]) + F.coalesce(F.length(x["found"]), F.lit(0))
        return after, F.array(F.struct(at.alias("at"), x["gap"].alias("text")))

    return F.when(F.rlike(text, F.lit(pattern)), _walk(steps, F.lit(0), step, kind)).otherwise(whole)


def _piece_spans(text: Column, cls: CharClass) -> Column:
    """(a, b) of the joined windows with enough entropy of one piece of ASCII text."""
    w = cls.width

    weights = [c * math.log2(c) if c else 0.0 for c in range(w + 2)]
    into = F.array(*(F.lit(b - a) for a, b in zip(weights, weights[1:])))
    limit = w * (math.log2(w) - cls.least)

    def change(window: Column, character: Column, less: int) -> Column:
        """What one more of a character adds to S, or (``less`` = 1) one less takes from it."""
        return F.get(into, F.length(window) - F.length(F.replace(window, character, F.lit(""))) - less)

    def step(state, i):
        begin = F.greatest(i - w, F.lit(0))

        def with_window(before):
            come, go = F.substr(text, i + 1, F.lit(1)), F.substr(before, F.lit(1), F.lit(1))
            moved = F.when(i < w, change(before, come, 0)).when(come == go, F.lit(0.0))
            return _let(state["s"] + moved.otherwise(change(before, come, 0) - change(before, go, 1)), with_total)

        def with_total(total):
            a, b = i - w + 1, i + 1
            spans = state["spans"]
            last = F.get(spans, F.size(spans) - 1)
            longer = F.concat(
                F.slice(spans, F.lit(1), F.greatest(F.size(spans) - 1, F.lit(0))),
                F.array(F.struct(last["a"].alias("a"), b.alias("b"))),
            )
            more = F.concat(spans, F.array(F.struct(a.alias("a"), b.alias("b"))))
            high = (i >= w - 1) & (total <= limit + 1e-9)
            after = F.when(~high, spans).when(F.coalesce(last["b"] >= a, F.lit(False)), longer).otherwise(more)
            return F.struct(total.alias("s"), after.alias("spans"))

        return _let(F.substr(text, begin + 1, i - begin), with_window)

    start = F.struct(F.lit(0.0).alias("s"), F.array().cast("array<struct<a:int,b:int>>").alias("spans"))
    return F.aggregate(F.sequence(F.lit(0), F.length(text) - 1), start, step, lambda s: s["spans"])


def _entropy_spans(candidate: Column, cls: CharClass, allowed: str | None) -> Column:
    """Spans of windows with enough entropy in one candidate span (begin, ..., found); they may touch."""
    w = cls.width

    def span(begin: Column, end: Column) -> Column:
        return F.struct(
            begin.alias("begin"), F.lit(KINDS.index("entropy")).alias("rank"), F.lit("entropy").alias("kind"),
            end.alias("end"), F.lit(None).cast("string").alias("found"),
        )

    def of_rest(rest: Column) -> Column:
        parts = F.regexp_extract_all(rest["text"], F.lit(f".{{1,{PIECE}}}"), F.lit(0))

        def of_parts(p: Column) -> Column:
            # each part with the first characters of the next one, so that every window lies in one of them
            tails = F.concat(F.slice(p, F.lit(2), F.size(p)), F.array(F.lit("")))
            both = F.arrays_zip(p.alias("own"), tails.alias("tail"))

            def of_part(x: Column, k: Column) -> Column:
                text = F.concat(x["own"], F.substr(x["tail"], F.lit(1), F.lit(w - 1)))
                shift = candidate["begin"] + rest["at"] + k * PIECE
                found = F.when(F.length(text) >= w, _let(text, lambda t: _piece_spans(t, cls)))
                found = F.coalesce(found, F.array().cast("array<struct<a:int,b:int>>"))
                return F.transform(found, lambda y: span(shift + y["a"], shift + y["b"]))

            return F.flatten(F.transform(both, of_part))

        return _let(parts, of_parts)

    rests = F.filter(_rests(candidate["found"], allowed), lambda r: F.length(r["text"]) >= w)
    return F.flatten(F.transform(rests, of_rest))


def _uncovered(base: Column, extra: Column) -> Column:
    """The spans ``extra`` that lie inside no span of ``base``, in order."""
    none = F.array().cast(f"array<{SPAN}>")

    def step(reach, x):
        own = x["rank"] == KINDS.index("entropy")
        after = F.when(own, reach).otherwise(F.greatest(reach, x["end"]))
        return after, F.when(own & (x["end"] > reach), F.array(x)).otherwise(none)

    return _walk(F.array_sort(F.concat(base, extra)), F.lit(0), step, SPAN)


def _join_spans(spans: Column) -> Column:
    """Touching spans of the method united; ``spans`` are in order."""
    none = F.array().cast(f"array<{SPAN}>")
    # a last span behind all others brings out the one that is still open
    last = F.struct(
        F.lit((1 << 31) - 1).alias("begin"), F.lit(0).alias("rank"), F.lit("").alias("kind"),
        F.lit(0).alias("end"), F.lit("").alias("found"),
    )

    def step(opened, x):
        over = F.coalesce(opened["end"] >= x["begin"], F.lit(False))
        grown = F.struct(
            opened["begin"].alias("begin"), x["rank"].alias("rank"), x["kind"].alias("kind"),
            F.greatest(opened["end"], x["end"]).alias("end"), x["found"].alias("found"),
        )
        return F.when(over, grown).otherwise(x), F.when(over | opened["begin"].isNull(), none).otherwise(F.array(opened))

    start = F.struct(
        F.lit(None).cast("int").alias("begin"), F.lit(0).alias("rank"), F.lit("").alias("kind"),
        F.lit(None).cast("int").alias("end"), F.lit("").alias("found"),
    )
    return F.when(F.size(spans) < 2, spans).otherwise(_walk(F.concat(spans, F.array(last)), start.cast(SPAN), step, SPAN))


def with_secret_spans(
    docs: DataFrame, classes: Sequence[CharClass] = CLASSES, allowed: Sequence[str] = ALLOWED
) -> DataFrame:
    """``docs`` with ``secret_spans``: array of (begin, rank, kind, end, found), in order of begin and kind;
    ``found`` is the text of a fixed pattern's span and null for spans of high entropy.

    Null and empty texts have no spans.  Positions count code points; the end is exclusive.  No row
    is dropped, repeated rows are judged alike, other columns are kept (one named ``secret_spans``
    is replaced).  Each row is judged by itself: there is no shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    assigns = (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & F.rlike(text, F.lit(ASSIGN_START))
    base = F.concat(
        _hits(text, ASSIGN, assigns, "assign", ASSIGN_LEAST),
        _hits(text, ACCESS, F.contains(text, F.lit("AKIA")), "access"),
        _hits(text, HEX, F.rlike(text, F.lit(HEX)), "hex"),
    )
    out = docs.withColumn("secret_spans", F.array_sort(base))
    extra = F.array().cast(f"array<{SPAN}>")
    cut = "|".join(f"(?:{a})" for a in _numbered_groups(allowed)) or None
    for cls in classes:
        run = f"[{cls.characters}]{{{cls.width},}}"
        candidates = _hits(text, run, F.rlike(text, F.lit(run)), "entropy")
        found = F.flatten(F.transform(candidates, lambda c: _entropy_spans(c, cls, cut)))
        extra = F.concat(extra, _let(found, _join_spans))
    joined = _let(extra, lambda e: F.when(
        F.size(e) > 0, _let(_uncovered(F.col("secret_spans"), e), _join_spans)
    ).otherwise(e))
    return out.withColumn("secret_spans", F.array_sort(F.concat(F.col("secret_spans"), joined)))


def _numbered_groups(patterns: Sequence[str]) -> list[str]:
    """Patterns for one alternation: ``\\g`` becomes a reference to the pattern's own (only) group."""
    out, groups = [], 0
    for p in patterns:
        own = re.compile(p.replace("\\g", "")).groups
        out.append(p.replace("\\g", f"\\{groups + 1}"))
        groups += own
    return out


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["begin"], x["end"])), ",")


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, SHA-256 of the base spans' text, all spans' text."""
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda x: x["kind"] != "entropy")
    picked = with_secret_spans(docs.select("doc_id", "text"))
    return picked.select(
        "doc_id",
        *[
            F.size(F.filter(spans, _of_kind(k))).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")
        ],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; overlapping spans by one mark.

    ``n_chars``, where there is such a column, is set anew for texts that changed.  Null texts stay null.
    """
    spans = F.col("secret_spans")
    # a last, empty span brings out the text behind the others
    end = F.length("text")
    last = F.struct(
        end.alias("begin"), F.lit(0).alias("rank"), F.lit("").alias("kind"), end.alias("end"), F.lit("").alias("found")
    )

    def cut(pieces: Column) -> Column:
        def step(at, x):
            begin = F.greatest(x["begin"], at)
            first = F.floor(at / TEXT_PIECE).cast("int")
            near = F.slice(pieces, first + 1, F.floor(begin / TEXT_PIECE).cast("int") - first + 1)
            kept = F.substr(F.array_join(near, ""), at - first * TEXT_PIECE + 1, begin - at)
            fresh = F.when(x["begin"] < at, F.array().cast("array<string>")).otherwise(F.array(kept, F.lit(mark)))
            return F.greatest(at, x["end"]), fresh

        parts = _walk(F.concat(spans, F.array(last)), F.lit(0), step, "string")
        return _let(parts, lambda p: F.array_join(F.slice(p, F.lit(1), F.size(p) - 1), ""))

    # places are counted from the begin of a piece, not of the text
    clean = _let(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{TEXT_PIECE}}}"), F.lit(0)), cut)
    kinds = dict(docs.dtypes)
    out = with_secret_spans(docs).withColumn("text", F.when(F.size(spans) > 0, clean).otherwise(F.col("text")))
    if "n_chars" in kinds:
        counted = F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", counted.cast(kinds["n_chars"]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
