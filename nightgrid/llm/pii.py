"""Personal data: fixed patterns, and further spans chosen by boosted trees.

The fixed patterns find what is certain.  High-recall generators propose overlapping
spans in other writings (an address with "at" and "dot", numbers with unusual
separators, hexadecimal addresses) and secrets (values given to a name such as password
or token, long runs that mix letters and digits).  Boosted trees score each by its form
and context; spans above a threshold of the calibrated score are added, best first,
where they overlap nothing found before.

The trees learn in the contexts of the corpus itself.  In a bounded sample of the found
spans the certain ones are rewritten in other forms (positive), or replaced by numbers
and words that only look alike: dates, prices, versions, failing check digits (negative).
Their contexts also get imitated secrets, and values that are none: hashes of commits,
identifiers, paths, masked values, plain words.  A corpus with few certain spans of a
kind is filled up with invented ones, so there is a model at every size.

Generators have bounds of form: a spelled-out address has up to 64 characters before
the "at" and four further labels, a number up to 42 characters, a named value 6 to 200.
"""

from __future__ import annotations

import heapq
import math
import random
import re
import string
import warnings
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from nightgrid.llm import boosting
from nightgrid.llm.common import replaced, table

#: Kinds of the fixed patterns, and those that only the trees add.
KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
#: Bound of the training sample: certain spans of the whole corpus.
SAMPLE_SPANS = 1_500
#: Fewer rows give no model; kinds with fewer spans are filled up with invented ones.
LEAST_SPANS = 40
CONTEXT = 32
#: Thresholds are chosen on held-out rows for this share of right spans, at least THRESHOLD.
PRECISION, THRESHOLD = 0.98, 0.9

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
# The looked-behind digit only spares starts inside a run, which could match no better.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost addresses, found from each ``@``: the run before it, back to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        end = None
        if at > done and (domain := _DOMAIN.match(text, at)):
            start = at
            while start > done and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at:
                end = domain.end()
                yield Span("email", start, end)
                done = end
        at = text.find("@", end or at + 1)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by kind, then start."""
    found = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            found.append(Span("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            found.append(Span("card", *m.span()))
    if "+" in text:
        found += [Span("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return found


_AT = r"(?: ?[\[({] ?at ?[\])}] ?| at |@| @ )"
_DOT = r"(?: ?[\[({] ?dot ?[\])}] ?| dot |\.| \. )"
_SPELLED = re.compile(rf"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{{1,64}}{_AT}[a-z0-9-]{{1,63}}(?:{_DOT}[a-z0-9-]{{1,63}}){{1,4}}")
_SPELLED_SIGN = re.compile(r"(?i)[\[({] ?(?:at|dot) ?[\])}]| dot | @ ")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])[(]?[0-9][0-9 ().\[\]/_-]{5,40}[0-9](?![0-9A-Za-z])")
_SIX = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
#: A value after a colon or equals sign, the name that must stand before it, and long runs.
_GIVEN = re.compile(r"[:=]>?[ \t]{0,3}[\"'`]?([^\s\"'`<>,;]{6,200})")
_NAME = re.compile(
    r"(?i)(?:pass(?:word|wd|phrase|code)?|pwd|token|secret|key|credentials?|auth|bearer)[A-Za-z0-9_-]{0,16}[\"'`]?[ \t]{0,3}$"
)
_OPAQUE = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}+={0,2}")
_DOTTED = re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?: ?[\[(]?\.[\])]? ?[0-9]{1,3}){3}(?![0-9A-Za-z])")


def candidates(text: str) -> list[Span]:
    """Overlapping proposals beyond the fixed patterns."""
    found = [Span("email", *m.span()) for m in _SPELLED.finditer(text)] if _SPELLED_SIGN.search(text) else []
    for m in _NUMBER.finditer(text):
        n = len(digits_of(m.group()))
        if 7 <= n <= 15:
            found.append(Span("phone", *m.span()))
        if 13 <= n <= 19:
            found.append(Span("card", *m.span()))
    found += [Span("ip", *m.span()) for m in _DOTTED.finditer(text)]
    if "::" in text or text.count(":") > 3:
        found += [Span("ip", *m.span()) for m in _SIX.finditer(text) if m.end() - m.start() > 6]
    secrets = [
        Span("secret", *m.span(1)) for m in _GIVEN.finditer(text)
        if _NAME.search(text[max(0, m.start() - CONTEXT) : m.start()])
    ] if ":" in text or "=" in text else []
    secrets += [Span("secret", *m.span()) for m in _OPAQUE.finditer(text) if _MIXED.search(m.group())]
    return found + list(dict.fromkeys(secrets))


_MIXED = re.compile(r"[0-9][^0-9]*?[A-Za-z]|[A-Za-z][^A-Za-z]*?[0-9]")
#: First characters of well-known kinds of keys and signed tokens.
_KEY_STARTS = re.compile(r"AKIA|ASIA|AIza|gh[pousr]_|glpat-|sk[-_]|pk[-_]|rk_|xox[abpr]-|eyJ|npm_|SG\.")
_WORDS_NEAR = [
    re.compile(p, re.I) for p in (
        r"phone|tel\b|tel[.:]|call|mobile|fax|cell|telefon|tél|llam|appel",
        r"mail|contact|write|reach|kontakt|correo|courriel",
        r"card|visa|credit|pay|karte|carte|tarjeta",
        r"\bip\b|server|host|address|login|adresse",
        r"version|\bv\b|isbn|order|invoice|no\.|nr\.|page|total|date|price|datum|fecha|prix|[$€£]",
        r"pass|pwd|token|secret|api|auth|bearer|credential",
        r"commit|sha|md5|hash|uuid|\bid\b|digest|etag|checksum|rev",
        r"key",
    )
]
_GIVEN_BEFORE = re.compile(r"[:=]>?[ \t]{0,3}[\"'`]?$")


def _mixture(value: str) -> list[float]:
    """How random a value looks: entropy, kinds of characters, and changes between them."""
    size = len(value)
    counts = [value.count(c) for c in set(value)]
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in value]
    return [
        -sum(n / size * math.log2(n / size) for n in counts), len(counts), kinds.count("u") / size, kinds.count("l") / size,
        kinds.count("s") / size, kinds.count("d") / size, sum(a != b for a, b in zip(kinds, kinds[1:])) / size,
        float(set(value) <= set("0123456789abcdef")), max(len(x) for x in re.split("[^A-Za-z]", value)) / size,
        float(bool(_KEY_STARTS.match(value))),
    ]


def features(text: str, span: Span) -> list[float]:
    value = text[span.start : span.end]
    before, after = text[max(0, span.start - CONTEXT) : span.start], text[span.end : span.end + CONTEXT]
    digits, groups = digits_of(value), re.findall("[0-9]+", value)
    sizes = [len(g) for g in groups] or [0]
    low = value.lower()
    return [
        float(ALL_KINDS.index(span.kind)), len(value), len(digits), sum(c.isalpha() for c in value), len(groups),
        max(sizes), min(sizes), sizes[0], sizes[-1], float(bool(digits) and luhn(digits)), value.count("."),
        value.count("-"), value.count(" "), value.count("/"), value.count(":"), value.count("(") + value.count("["),
        float(value[0] == "("), float("@" in value), float(bool(re.search(r"\bat\b", low))),
        float(bool(re.search(r"\bdot\b", low))), float(bool(re.search(r"[\[({] ?(?:at|dot)", low))),
        float(all(int(g) <= 255 for g in groups if len(g) < 5) and max(sizes) < 4),
        float(digits[:1] or 0), float(digits[:2] in ("19", "20")), float(len(set(sizes)) == 1),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(after[:1] in ("%", "€", "$", "°")),
        *[float(bool(p.search(before))) for p in _WORDS_NEAR], float(bool(_GIVEN_BEFORE.search(before))), *_mixture(value),
    ]


def _rewritten(kind: str, value: str, rng: random.Random) -> str:
    digits = digits_of(value)
    if kind == "email":
        at, dot = rng.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."), (" @ ", ".")])
        local, domain = value.rsplit("@", 1)
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        if rng.random() < 0.4:
            return ":".join(f"{rng.randrange(1 << 16):x}" for _ in range(8)) if rng.random() < 0.5 else f"fe80::{rng.randrange(1 << 16):x}:{rng.randrange(1 << 16):x}"
        return value.replace(".", rng.choice(["[.]", "(.)", " . "]))
    if kind == "card":
        sep = rng.choice([".", "/", "_"])
        return sep.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    tail = digits[-10:]
    a, b, c = tail[:3], tail[3:6], tail[6:]
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{a} {b} {c}", f"00{digits[:2]} {a} {b}{c}"])


def _lookalike(kind: str, value: str, rng: random.Random) -> str:
    r = rng.randrange
    if kind == "email":
        return rng.choice([f"look at this dot {r(99)}", "meet at noon dot the end", f"{r(99)} @ {r(9)}.{r(99)}"])
    if kind == "ip":
        return rng.choice([
            f"{r(24)}:{r(60):02}:{r(60):02}", f"{r(300, 999)}.{r(999)}.{r(999)}.{r(999)}", f"{r(9)} . {r(999)} . {r(300, 999)} . {r(9)}",
            f"{r(24):02}:{r(60):02}:{r(60):02}:{r(30):02}",
        ])
    if kind == "card":
        digits = digits_of(value)
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + r(8)) % 10)
        sep = rng.choice([".", "/", "_", " ", ""])
        return sep.join(wrong[i : i + 4] for i in range(0, len(wrong), 4))
    return rng.choice([
        f"{r(1900, 2030)}-{r(1, 13):02}-{r(1, 29):02}", f"{r(1, 29)}.{r(1, 13):02}.{r(1900, 2030)}", f"{r(1, 29)}/{r(1, 13)}/{r(1900, 2030)}",
        f"{r(99)}.{r(999):03}.{r(999):03}", f"{r(99)} {r(999):03} {r(999):03}.{r(99):02}", f"{r(1900, 2030)} - {r(1900, 2030)}",
        f"978-{r(9)}-{r(99):02}-{r(999999):06}-{r(9)}", f"{r(10**7, 10**9)}", f"{r(9)}.{r(20)}.{r(20)}-{r(9999):04}", f"{r(1900, 2030)}{r(1, 13):02}{r(1, 29):02}",
    ])


_HEX, _ALNUM = "0123456789abcdef", string.ascii_letters + string.digits
_NAMES = ["password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "access_key", "client_secret", "auth_token", "private-key"]
_PLAIN = ["required", "identifier", "string", "nothing", "undefined", "changed", "optional", "whatever", "is-missing", "not_given", "important"]


def _drawn(rng: random.Random, letters: str, least: int, most: int) -> str:
    return "".join(rng.choices(letters, k=rng.randint(least, most)))


def _secret(rng: random.Random) -> tuple[str, str, str]:
    """What stands before an imitated secret, the secret, and what stands after it."""
    value = rng.choice([
        lambda: _drawn(rng, _HEX, 16, 64), lambda: _drawn(rng, _ALNUM, 12, 48), lambda: _drawn(rng, string.ascii_uppercase + string.digits, 16, 32),
        lambda: _drawn(rng, _ALNUM + "+/", 20, 64) + "=" * rng.randrange(3), lambda: _drawn(rng, _ALNUM + "!#$%&*?@^_-", 8, 20),
    ])()
    started = rng.choice([
        lambda: rng.choice(["AKIA", "ASIA"]) + _drawn(rng, string.ascii_uppercase + string.digits, 16, 16),
        lambda: rng.choice(["ghp_", "gho_", "npm_"]) + _drawn(rng, _ALNUM, 36, 36), lambda: "AIza" + _drawn(rng, _ALNUM + "_-", 35, 35),
        lambda: rng.choice(["sk_", "sk-", "pk_", "glpat-"]) + _drawn(rng, _ALNUM, 20, 48), lambda: "xoxb-" + _drawn(rng, string.digits, 11, 12) + "-" + _drawn(rng, _ALNUM, 24, 24),
    ])()
    if rng.random() < 0.3:
        return rng.choice(["", "", "key ", "use ", "Bearer "]), started, ""
    name = rng.choice(_NAMES)
    name = rng.choice([name, name.upper(), name.capitalize(), "db_" + name, f'"{name}"'])
    sign, end = rng.choice([("=", ""), (" = ", ""), (": ", ""), (":", ""), ('="', '"'), (' = "', '"'), (": '", "'"), ("='", "'")])
    return name + sign, rng.choice([value, value, started]), end


def _no_secret(rng: random.Random) -> tuple[str, str, str]:
    """The same for values that only look like secrets."""
    hexes, word = _drawn(rng, _HEX, 32, 64), rng.choice(_PLAIN)
    number = rng.randrange(1, 3000)
    bare = rng.choice([
        ("", hexes, ""), (rng.choice(["commit ", "sha256:", "md5=", "etag: ", "rev ", "id=", "hash: "]), hexes, ""),
        (rng.choice(["", "id: ", "uuid="]), "-".join(_drawn(rng, _HEX, n, n) for n in (8, 4, 4, 4, 12)), ""),
        ("", f"the-{number}-best-{word}-things", ""), ("/", f"usr/lib/part{number}/{word}/data", ""), ("", f"{word.capitalize()}{word.capitalize()}Part{number}", ""),
        ("", f"{word}_{word}_{number}_{rng.randrange(99)}", ""), ("", f"2024-{rng.randint(10, 12)}-{rng.randint(10, 28)}T10-{rng.randint(10, 59)}-00Z", ""),
        ("", f"{word.upper()}-{number}-{word.upper()}", ""),
    ])
    name = rng.choice([*_NAMES, "key", "keyword", "author", "tokens"])
    given = rng.choice([word, word.capitalize(), "*" * rng.randint(6, 12), f"{word}.{word}", f"get_{word}()", f"${{{word.upper()}}}", "x" * rng.randint(6, 12), f"{word}{rng.randrange(9)}"])
    return rng.choice([bare, (name + rng.choice(["=", " = ", ": "]), given, "")])


def _invented(kind: str, k: int) -> tuple[str, str, str, str]:
    """A certain span without a corpus, for kinds that a corpus hardly has."""
    rng = random.Random(f"{kind}{k}")
    number = _drawn(rng, string.digits, 14, 14)
    value = {
        "email": f"{_drawn(rng, string.ascii_lowercase, 3, 9)}{k}@{_drawn(rng, string.ascii_lowercase, 3, 9)}.example.org",
        "ip": ".".join(str(rng.randrange(256)) for _ in range(4)),
        "card": next(c for d in string.digits if luhn(c := f"4{number}{d}")),
        "phone": f"+{rng.randint(1, 99)} ({number[:3]}) {number[3:6]}-{number[6:10]}",
    }[kind]
    lead = {"email": "write to ", "ip": "from host ", "card": "paid by card ", "phone": "please call "}[kind]
    return kind, lead, value, rng.choice([" now", ".", ", then", ""])


class Finder(NamedTuple):
    """What finds personal data in one text; without a model only the fixed patterns."""

    model: boosting.Model | None
    thresholds: dict[str, float]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        if self.model is None or not (found := candidates(text)):
            return []
        spans = [s for s in found if not any(s.start < b.end and b.start < s.end for b in base)]
        if not spans:
            return []
        chance = self.model.probability(np.array([features(text, s) for s in spans]))
        chosen: list[Span] = []
        taken: set[int] = set()
        for k in sorted(range(len(spans)), key=lambda k: (-chance[k], spans[k])):
            s = spans[k]
            if chance[k] >= self.thresholds[s.kind] and taken.isdisjoint(range(s.start, s.end)):
                chosen.append(s)
                taken.update(range(s.start, s.end))
        return chosen


def train(rows: list[tuple[str, str, str, str]]) -> Finder:
    """Fit on (kind, before, value, after) of certain spans; too few give no model, and a warning."""
    if len(rows) < LEAST_SPANS:
        warnings.warn(f"no model of personal data: {len(rows)} of {LEAST_SPANS} certain spans", stacklevel=2)
        return Finder(None, {})
    x, y, held = [], [], []

    def learn(text: str, whole: Span, label: int, out: bool) -> None:
        for span in candidates(text):
            if span.start < whole.end and whole.start < span.end:
                x.append(features(text, span))
                y.append(label and span == whole)
                held.append(out)

    for kind, before, value, after in rows:
        rng = random.Random(zlib.crc32(f"{kind}{before}{value}{after}".encode()))
        for label in (1, 0, 0):
            new = (_rewritten if label else _lookalike)(kind, value, rng)
            learn(before + new + after, Span(kind, len(before), len(before) + len(new)), label, rng.random() < 0.3)
        for label in (1, 0):
            lead, new, end = (_secret if label else _no_secret)(rng)
            # The next word does not run into the value.
            lead = f"{before.rsplit(' ', 1)[0]} {lead}"
            learn(f"{lead}{new}{end} {after}", Span("secret", len(lead), len(lead) + len(new)), label, rng.random() < 0.3)
    x, y, held = np.array(x, float), np.array(y, bool), np.array(held, bool)
    if not len(y) or y[~held].all() or not y[~held].any():
        return Finder(None, {})
    model = boosting.fit(x, y, held)
    chance, thresholds = model.probability(x), {}
    for k, kind in enumerate(ALL_KINDS):
        of = held & (x[:, 0] == k)
        order = np.argsort(-chance[of])
        right = np.cumsum(y[of][order]) / np.arange(1, of.sum() + 1)
        good = np.flatnonzero(right >= PRECISION)
        # Of the held-out rows, as many from the top as keep the precision.
        least = float(chance[of][order][good[-1]]) if len(good) else 2.0
        thresholds[kind] = max(THRESHOLD, least)
    return Finder(model, thresholds)


#: Java's form of what every text with a certain span has; it only spares texts without one.
_MAY_HAVE = r"@[A-Za-z0-9-]+\.|\+[0-9]|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|[0-9](?:[ -]?[0-9]){12}"


def fit_finder(docs: DataFrame, text: str = "text") -> Finder:
    """Train on at most ``SAMPLE_SPANS`` different certain spans, drawn by hash from all rows.

    Each task keeps only the spans of smallest hashes, so little is shuffled; copies give
    the same span, and the sample is the same in every run over the same rows.  Kinds with
    fewer than ``LEAST_SPANS`` spans in it are filled up with invented ones.
    """
    whole = F.col(text).cast("string")
    names = ["h", "kind", "before", "value", "after"]

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Largest hash first, so that the largest is replaced.
        heap: list[tuple] = []
        kept: set[tuple] = set()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for s in base_spans(t):
                    row = (s.kind, t[max(0, s.start - CONTEXT) : s.start], t[s.start : s.end], t[s.end : s.end + CONTEXT])
                    item = (-xxhash.xxh3_64_intdigest("\0".join(row).encode("utf-8", "surrogatepass")) // 2, row)
                    if item in kept or len(heap) == SAMPLE_SPANS and item <= heap[0]:
                        continue
                    kept.add(item)
                    if len(heap) < SAMPLE_SPANS:
                        heapq.heappush(heap, item)
                    else:
                        kept.discard(heapq.heappushpop(heap, item))
        columns = list(zip(*((-h, *row) for h, row in heap), strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string() if k else pa.int64()) for k, c in enumerate(columns)], names
        )

    spans = docs.select(whole.alias("t")).where(F.col("t").rlike(_MAY_HAVE)).mapInArrow(
        contexts, "h long, kind string, before string, value string, after string"
    )
    rows = [tuple(r)[1:] for r in spans.distinct().orderBy(*names).limit(SAMPLE_SPANS).collect()]
    for kind in KINDS:
        rows += [_invented(kind, k) for k in range(LEAST_SPANS - sum(r[0] == kind for r in rows))]
    return train(rows)


_ORDER = {kind: k for k, kind in enumerate(ALL_KINDS)}


def _by_kind(span: Span) -> tuple[int, int, int]:
    return _ORDER[span.kind], span.start, span.end


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= done:
            out += [text[done : span.start], f"[{span.kind.upper()}]"]
        done = max(done, span.end)
    return "".join(out) + text[done:]


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_pii(docs: DataFrame, text: str = "text", finder: Finder | None = None, redact: bool = False) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` (arrays of kind, start, end by kind, then start).

    Places count code points; ``end`` is exclusive.  ``redact`` adds ``redacted``: the
    text without the spans (null stays null).  A null text counts as an empty one and has
    no spans.  Columns of the result's names are replaced.
    """
    finder = finder or fit_finder(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(finder)
    kind = f"struct<base:{_SPANS},all:{_SPANS}" + ",redacted:string>" if redact else f"struct<base:{_SPANS},all:{_SPANS}>"

    @F.arrow_udf(kind)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = shared.value
        for batch in batches:
            base, full, clean = [], [], []
            for value in batch.to_pylist():
                first = base_spans(value or "")
                every = sorted([*first, *finder.added(value or "", first)], key=_by_kind)
                base.append([s._asdict() for s in sorted(first, key=_by_kind)])
                full.append([s._asdict() for s in every])
                if redact:
                    clean.append(None if value is None else redacted(value, every))
            arrays = [pa.array(base, _SPAN_TYPE), pa.array(full, _SPAN_TYPE)]
            names = ["base", "all"]
            if redact:
                arrays, names = [*arrays, pa.array(clean, pa.string())], [*names, "redacted"]
            yield pa.StructArray.from_arrays(arrays, names)

    found = replaced(docs, {"__llm_pii": find(F.col(text).cast("string"))})
    columns = {"base_spans": F.col("__llm_pii.base"), "spans": F.col("__llm_pii.all")}
    if redact:
        columns["redacted"] = F.col("__llm_pii.redacted")
    return replaced(found, columns).drop("__llm_pii")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        (F.size("spans") - F.size("base_spans")).cast("long").alias("n_added"),
    )
