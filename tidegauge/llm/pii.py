"""Personal data: exact base patterns, and a character tagger (bidirectional LSTM with CRF) that adds spans.

Base spans are the leftmost non-overlapping matches of each kind's pattern that pass its test. The tagger
is trained on the driver, in numpy, on labelled windows: those around base spans and around other digits
in a bounded sample of documents (SAMPLE of them expected, chosen by a hash of the id; at most WINDOWS
windows), variants of these spans that the patterns miss (telephone numbers without a plus, card numbers
with other separators, e-mail addresses with at and dot written out), and a few seeds of each kind, so that
every kind is known.

Every span holds an anchor: a digit, an at sign, or a written at or dot. The whole text is searched for
anchors, and overlapping windows cover all of them with their surroundings; a window without one could only
give spans that the rule forbids. Windows are decoded on their own; spans cut off by a window's edge are left to the window
that overlaps it there. All spans of a document are then reconciled at once: an added span must pass its
kind's test, be likely enough and touch no base span, and of overlapping ones the set with the largest
total probability stays (weighted interval scheduling).

A null text is empty and has no spans. Repeated rows are treated alike. An empty table gives an empty
result; other columns are ignored (kept by `redact`). Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import common
from tidegauge.llm.chunks import release
from tidegauge.llm.tagger import Tagger, char_classes

KINDS = ("email", "ip", "card", "phone")
SAMPLE, WINDOWS, STEPS = 3000, 4000, 300
#: Made-up training texts.
SEEDS = 3000
WIDTH, STRIDE, AROUND = 96, 48, 24
LIKELY = 0.9

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: E-mail addresses as the tagger may add them: with an at or dot written out, one of them in brackets or between blanks.
_BRACKETS = r"\x20?[\[({<]\x20?%s\x20?[\])}>]\x20?"
WRITTEN = re.compile(rf"[a-z0-9._%+-]+(?:@|{_BRACKETS % 'at'}|\x20at\x20)[a-z0-9-]+(?:(?:\.|{_BRACKETS % 'dot'}|\x20dot\x20)[a-z0-9-]+)+", re.I)
MARKS = re.compile(r"[\[({<]\x20?(?:at|dot)\x20?[\])}>]|\x20dot\x20", re.I)
ANCHORS = re.compile(r"[0-9@]+")
LONG = re.compile(r"[0-9](?:[\x20().,/-]{0,2}[0-9])+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def valid(kind: int, s: str) -> bool:
    """The test that a span of a kind must pass, found by a pattern or by the tagger."""
    if kind == 0:
        return EMAIL.fullmatch(s) is not None or MARKS.search(s) is not None and WRITTEN.fullmatch(s) is not None
    if kind == 1:
        return IP.fullmatch(s) is not None and all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in s.split("."))
    d = _digits(s)
    return 14 <= len(d) <= 19 and luhn(d) if kind == 2 else 10 <= len(d) <= 15


def base_spans(text: str) -> list[Span]:
    """Sorted by start, then kind."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        # only the run of characters before the sign can start a match
        if start < at and (m := EMAIL.match(text, start)):
            end = m.end()
            found.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if valid(kind, m[0])]
    return sorted(found)


def joined(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def window_starts(text: str) -> list[int]:
    """Starts of the windows that cover every anchor with AROUND characters on both sides, half a window apart."""
    regions: list[list[int]] = []
    anchors = [m.span() for m in ANCHORS.finditer(text)]
    if marks := [m.span() for m in MARKS.finditer(text)]:
        anchors = sorted(anchors + marks)
    for start, end in anchors:
        a, b = max(0, start - AROUND), min(len(text), end + AROUND)
        if regions and a <= regions[-1][1]:
            regions[-1][1] = max(b, regions[-1][1])
        else:
            regions.append([a, b])
    out = []
    for a, b in regions:
        if b - a <= WIDTH:
            out.append(max(0, (a + b - WIDTH) // 2))
        else:
            out += range(a, b - WIDTH + STRIDE, STRIDE)
    return out


def tags_of(text: str, start: int, width: int, spans: list[Span]) -> np.ndarray:
    y = np.zeros(width, np.int64)
    for a, k, b in spans:
        y[max(0, a - start) : max(0, min(width, b - start))] = k + 1
    return y


def _encoded(texts: list[str], width: int) -> np.ndarray:
    x = np.zeros((len(texts), width), np.int64)
    for row, t in zip(x, texts, strict=True):
        own = char_classes(t[:width])
        row[: len(own)] = own
    return x


def tagged_spans(tags: np.ndarray, sure: np.ndarray, length: int) -> Iterator[tuple[int, int, int, float]]:
    """Runs of one tag in a window's first `length` places: start, kind, end, mean probability."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], tags[:length], [0]))))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if tags[a]:
            yield a, int(tags[a]) - 1, b, float(sure[a:b, tags[a]].mean())


def reconcile(text: str, base: list[Span], found: dict[Span, float]) -> list[Span]:
    """Base spans and the likeliest set of added ones that touch neither them nor each other."""
    starts = [a for a, _, _ in base]
    ends = np.maximum.accumulate([b for _, _, b in base]).tolist() if base else []

    def free(a: int, b: int) -> bool:
        k = bisect_right(starts, b - 1)
        return not k or ends[k - 1] <= a

    options = sorted((b, a, k, p) for (a, k, b), p in found.items() if a < b and p >= LIKELY and free(a, b) and valid(k, text[a:b]))
    best: list[tuple[float, list | None]] = [(0.0, None)]
    for n, (b, a, k, p) in enumerate(options):
        before = bisect_right(options, a, 0, n, key=lambda o: o[0])
        taken = best[before][0] + p
        best.append((taken, [(a, k, b), best[before]]) if taken > best[-1][0] else best[-1])
    added, top = [], best[-1][1]
    while top:
        added.append(top[0])
        top = top[1][1]
    return sorted(base + added)


def find(texts: list[str], tagger: Tagger) -> Iterator[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    bases = [base_spans(t) for t in texts]
    starts = [window_starts(t) for t in texts]
    found: list[dict[Span, float]] = [{} for _ in texts]
    places = [(n, s) for n, own in enumerate(starts) for s in own]
    for k in range(0, len(places), 512):
        own = places[k : k + 512]
        x = _encoded([texts[n][s : s + WIDTH] for n, s in own], WIDTH).T
        e, _ = tagger.emissions(x)
        tags, sure = tagger.decode(e), tagger.marginals(e)[1]
        for row, (n, s) in enumerate(own):
            size = min(WIDTH, len(texts[n]) - s)
            for a, kind, b, p in tagged_spans(tags[:, row], sure[:, row], size):
                # a span cut off by an edge lies whole in the window before or after
                if (a > 0 or s == 0) and (b < size or s + b == len(texts[n])):
                    a, b = _trimmed(texts[n], kind, s + a, s + b)
                    span = (a, kind, b)
                    found[n][span] = max(p, found[n].get(span, 0.0))
    for text, base, own in zip(texts, bases, found, strict=True):
        yield base, reconcile(text, base, own)


def _trimmed(text: str, kind: int, a: int, b: int) -> tuple[int, int]:
    """Numbers start and end with a digit (or a leading plus); addresses reach to the ends of their outer words."""
    if kind == 0:
        while a < b and text[a] not in LOCAL:
            a += 1
        while a < b and text[b - 1] not in LOCAL:
            b -= 1
        while a and a < b and text[a - 1] in LOCAL:
            a -= 1
        while a < b < len(text) and text[b] in LOCAL and text[b] not in "._%+":
            b += 1
    else:
        while a < b and not ("0" <= text[a] <= "9" or kind == 3 and text[a] in "+("):
            a += 1
        while a < b and not "0" <= text[b - 1] <= "9":
            b -= 1
    return a, b


def _seeds(many: int = SEEDS, seed: int = 5) -> list[tuple[str, list[Span]]]:
    """Short labelled texts of every kind, and of numbers and marks that are none, made by rule.

    Words around are made like those inside addresses, so that letters alone say nothing.
    """
    rng = np.random.default_rng(seed)
    pick = lambda s, n: "".join(rng.choice(list(s), n))
    letters = "aabcdeeefghiijklmnnooprrssttuuvwxyz"
    word = lambda: pick(letters, int(rng.integers(1, 10)))

    def prose(words: int) -> str:
        own = [word() for _ in range(words)]
        return "".join((w.capitalize() if rng.random() < 0.1 else w) + ("", "", "", "", ",", ".")[int(rng.integers(0, 6))] + " " for w in own)

    out = []
    for n in range(many):
        kind, n = n % 5, n // 5
        if kind == 0:
            s = word() + (".", "_", "", "-")[n // 7 % 4] + word() + "@" + word() + "." + ("com", "org", "net", "example", word())[n % 5]
            if n % 3:
                s = written(s, n)
        elif kind == 1:
            s = ".".join(str(x) for x in rng.integers(0, 256, 4))
        elif kind == 2:
            d = pick("0123456789", 15)
            d += next(c for c in "0123456789" if luhn(d + c))
            s = (" ", "-", "", ".")[n % 4].join(d[k : k + 4] for k in range(0, 16, 4))
        elif kind == 3:
            s = ("+1 (%s) %s-%s", "+%s %s %s", "%s-%s-%s", "(%s) %s-%s")[n % 4] % (pick("23456789", 3), pick("0123456789", 3), pick("0123456789", 4))
        else:
            s = (
                pick("0123456789", int(rng.integers(1, 8))),
                f"{rng.integers(1, 99)}.{rng.integers(0, 99)}",
                f"2{pick('0123456789', 3)}-0{pick('123456789', 1)}-1{pick('012345678', 1)}",
                pick("0123456789abcdef", 32),
                f"{word()} at {word()}",
                f"{word()} dot {word()}",
                f"({('at', 'dot', word())[n // 8 % 3]}) {word()}",
                f"[{('at', 'dot', word())[n // 8 % 3]}] {word()}. {word()}",
            )[n % 8]
        # a window that holds the span anywhere
        left = prose(24)[-int(rng.integers(1, WIDTH - len(s))) :]
        right = (" ", ". ", ", ", "\n")[int(rng.integers(0, 4))] + prose(24)
        out.append(((left + s + right)[: max(WIDTH, len(left) + len(s))], [(len(left), kind, len(left) + len(s))] if kind < 4 else []))
    return out


#: Ways to write out the at and the dots of an address.
AT, DOT = (" at ", " [at] ", "(at)", "@", "[at]"), (" dot ", " [dot] ", ".", " dot ", "[dot]")


def written(address: str, n: int) -> str:
    """An e-mail address with at and dots of its domain written out, in the n-th way; not in the way that the pattern finds."""
    name, _, domain = address.partition("@")
    at, dot = AT[n % 5], DOT[n // 5 % 5]
    if dot == "." and "t" not in at or at == " at " and dot == ".":
        dot = " dot "
    return name + at + domain.replace(".", dot)


def _variants(text: str, spans: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """The text with one span written in a way that the patterns miss."""
    for a, k, b in spans:
        if k == 3 and text[a] == "+":
            new = text[a:b].lstrip("+")
        elif k == 2:
            d = _digits(text[a:b])
            new = ".".join(d[n : n + 4] for n in range(0, len(d), 4))
        elif k == 0 and EMAIL.fullmatch(text[a:b]):
            new = written(text[a:b], a + b)
        else:
            continue
        yield text[:a] + new + text[b:], [(a, k, a + len(new))]


def doubtful(text: str, spans: list[Span]) -> bool:
    """Whether a number as long as a telephone or card number stands outside the spans: its label isn't known."""
    return any(sum(c.isdigit() for c in m[0]) >= 10 and not any(a <= m.start() and m.end() <= b for a, _, b in spans) for m in LONG.finditer(text))


def training_windows(docs: DataFrame, sample: int = SAMPLE, most: int = WINDOWS) -> list[tuple[str, list[Span]]]:
    """Labelled windows from a bounded sample of docs (doc_id, text), in the order of a hash."""
    n = docs.count()
    mark = F.pmod(F.xxhash64(F.lit("pii"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 30))
    part = docs.filter((mark < int(min(1.0, sample / max(n, 1)) * (1 << 30))) & F.col("text").rlike("[0-9@]"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                spans = base_spans(text)
                for s in window_starts(text):
                    own = [(a - s, k, e - s) for a, k, e in spans if s <= a and e <= s + WIDTH]
                    cutoff = any(a < s < e or a < s + WIDTH < e for a, _, e in spans)
                    if not cutoff and not doubtful(text[s : s + WIDTH], own):
                        rows.append((text[s : s + WIDTH], [x for span in own for x in span]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.int32()))],
                ["window", "spans"],
            )

    found = part.select("doc_id", "text").mapInArrow(cut, "window string, spans array<int>")
    # `most` rows of WIDTH characters
    rows = found.orderBy(F.size("spans") == 0, F.xxhash64("window")).limit(most // 2).union(
        found.filter(F.size("spans") == 0).orderBy(F.xxhash64("window")).limit(most // 2),
    ).collect()
    return [(r.window, [tuple(r.spans[k : k + 3]) for k in range(0, len(r.spans), 3)]) for r in rows]


def train(docs: DataFrame, sample: int = SAMPLE, most: int = WINDOWS, steps: int = STEPS) -> Tagger:
    own = training_windows(docs, sample, most)
    rows = own + _seeds()
    rows += [v for text, spans in rows for v in _variants(text, spans)]
    x = _encoded([t for t, _ in rows], WIDTH)
    y = np.stack([tags_of(t, 0, WIDTH, s) for t, s in rows])
    tagger = Tagger(len(KINDS) + 1)
    tagger.fit(x, y, steps)
    return tagger


_taggers: dict[str, Tagger] = {}


def _shared(docs: DataFrame, tagger: Tagger):
    shared, key = docs.sparkSession.sparkContext.broadcast(tagger), uuid.uuid4().hex

    def get() -> Tagger:
        if key not in _taggers:
            _taggers.clear()
            _taggers[key] = shared.value
        return _taggers[key]

    return get


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tagger: Tagger | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added, n_spans (all spans)."""
    common.text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    get = _shared(docs, tagger or train(rows))
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", "n_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for base, spans in find([x or "" for x in b.column(1).to_pylist()], get()):
                kinds = [k for _, k, _ in base]
                out.append(
                    (
                        *[kinds.count(k) for k in range(len(KINDS))],
                        hashlib.sha256(joined(base).encode()).hexdigest(),
                        joined(spans),
                        len(spans) - len(base),
                        len(spans),
                    )
                )
            types = [*[pa.int64()] * len(KINDS), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[k] for r in out], t) for k, t in enumerate(types)]], names)

    return rows.mapInArrow(
        run,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long",
    )


def masked(text: str, spans: list[Span]) -> str:
    """Each stretch of overlapping spans replaced by the mark of its first span's kind."""
    out, at = [], 0
    for a, k, b in spans:
        if a < at:
            # overlaps the stretch before: its rest goes too
            at = max(at, b)
            continue
        out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = b
    return "".join([*out, text[at:]])


def redact(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str | None = "n_chars",
    tagger: Tagger | None = None,
) -> DataFrame:
    """docs with every span in the text replaced by <KIND> and n_chars counted anew; all rows and columns stay."""
    common.text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    get = _shared(docs, tagger or train(rows))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            texts = b.column(at).to_pylist()
            new = [x if x is None else masked(x, spans) for x, (_, spans) in zip(texts, find([x or "" for x in texts], get()), strict=True)]
            columns = list(b.columns)
            columns[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, docs_names)

    docs_names = docs.columns
    out = docs.mapInArrow(run, docs.schema)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.coalesce(F.length(text_col).cast(docs.schema[chars_col].dataType), F.col(chars_col)))
    return out
