import random
import re
from functools import cache

import numpy as np

from tidegauge.llm import pii
from tidegauge.llm.tagger import Tagger

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute(text):
    found = []
    for kind, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = (
                True,
                kind == 1 and all(int(x) <= 255 for x in m[0].split(".")),
                14 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0,
                10 <= len(digits) <= 15,
            )[kind]
            if ok:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_are_those_of_the_plain_patterns():
    rng = random.Random(1)
    parts = [*"0123456789.@+-() a é_%", "1.2.3.4", "255", "a@b.co", "4111 1111 1111 1111", "+1 (234) 555-0199", ".."]
    for _ in range(20000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000 + "@", "@" * 300_000, "+1" * 150_000):
        pii.base_spans(text)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    tagger = Tagger(3, 4)
    tagger.p = {k: rng.normal(0, 0.5, v.shape) for k, v in tagger.p.items()}
    x, y = rng.integers(0, 130, (6, 5)), rng.integers(0, 3, (6, 5))
    _, grads = tagger.gradients(x, y)
    for k, g in grads.items():
        at = tuple(int(n) for n in np.unravel_index(np.abs(g).argmax(), g.shape))
        old, step = tagger.p[k][at], 1e-2
        tagger.p[k][at] = old + step
        up, _ = tagger.gradients(x, y)
        tagger.p[k][at] = old - step
        down, _ = tagger.gradients(x, y)
        tagger.p[k][at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 2e-2 * max(1, abs(g[at])), k


def test_decode_is_the_best_path():
    from itertools import product

    rng = np.random.default_rng(1)
    tagger = Tagger(3, 4)
    tagger.p["t"] = rng.normal(0, 1, (3, 3))
    e = rng.normal(0, 1, (5, 2, 3))
    for row in range(2):
        score = lambda p: sum(e[t, row, k] for t, k in enumerate(p)) + sum(tagger.p["t"][a, b] for a, b in zip(p, p[1:]))  # noqa: E731, B023
        assert tuple(tagger.decode(e)[:, row]) == max(product(range(3), repeat=5), key=score)


def test_reconcile_keeps_base_and_the_likeliest_set():
    text = "4111111111111111 and 2345550199 here 10.0.0.1"
    base = pii.base_spans(text)
    found = {(21, 3, 31): 0.99, (21, 3, 30): 0.5, (0, 3, 11): 0.99}
    assert pii.reconcile(text, base, found) == sorted([*base, (21, 3, 31)])


def test_windows_cover_every_anchor():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab c1") if rng.random() < 0.2 else "x" for _ in range(rng.randint(0, 900)))
        starts = pii.window_starts(text)
        for k, c in enumerate(text):
            if c in "0123456789@":
                assert any(s <= max(0, k - pii.AROUND) and min(len(text), k + pii.AROUND) <= s + pii.WIDTH for s in starts), (k, starts, len(text))


def test_detect_finds_variants_and_leaves_clean_text(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("aeinorsthld"), int(rng.integers(2, 9))))
    rows = []
    for n in range(120):
        words = [word() for _ in range(60)]
        if n % 3 == 0:
            words[30] = ("+1 (234) 555-01%02d" % (n % 100), "10.1.2.%d" % n, "joe.doe@mail%d.org" % n, "4111 1111 1111 1111")[n % 4]
        elif n % 3 == 1:
            words[30] = str(int(rng.integers(1, 99999)))
        rows.append((n, " ".join(words), f"s{n}"))
    rows += [(None, None, None), (500, "", "x"), (501, "reach me at (234) 555-0188 today or tomorrow", "x"), (501, "reach me at (234) 555-0188 today or tomorrow", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    tagger = pii.train(docs.select("doc_id", "text"), steps=120)
    got = pii.detect(docs, tagger=tagger).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for n, text, _ in rows:
        base = brute(text or "")
        assert set(pii.joined(base).split(",")) <= set(by[n].spans.split(",")) | {""}
    assert sum(by[n].n_added for n in range(120)) <= 2
    assert "phone:12:" in by[501].spans or "phone:13:" in by[501].spans
    clean = pii.redact(docs, tagger=tagger)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[None] is None and not any(brute(t) for t in texts.values() if t)
    assert pii.detect(docs.limit(0), tagger=tagger).count() == 0


@cache
def seeds_only():
    rows = pii._seeds()
    rows += [v for text, spans in rows for v in pii._variants(text, spans)]
    tagger = Tagger(len(pii.KINDS) + 1)
    tagger.fit(pii._encoded([t for t, _ in rows], pii.WIDTH), np.stack([pii.tags_of(t, 0, pii.WIDTH, s) for t, s in rows]), pii.STEPS)
    return tagger


def test_the_tagger_adds_what_the_patterns_miss():
    """Planted variants in unseen texts: most are found whole, and nothing else is added."""
    tagger, rng = seeds_only(), np.random.default_rng(99)
    pick = lambda s, n: "".join(rng.choice(list(s), n))
    word = lambda: pick("aeinorsthldmu", int(rng.integers(2, 9)))
    texts, want = [], []
    for n in range(600):
        kind, own = (0, 2, 3, None)[n % 4], [word() for _ in range(60)]
        if kind == 0:
            s = pii.written(f"{word()}.{word()}@{word()}.{('com', 'org', 'net')[n % 3]}", int(rng.integers(0, 25)))
        elif kind == 2:
            d = "4" + pick("0123456789", 14)
            d += next(c for c in "0123456789" if pii.luhn(d + c))
            s = ".".join(d[k : k + 4] for k in range(0, 16, 4))
        elif kind == 3:
            s = ("(%s) %s-%s", "%s-%s-%s", "%s %s %s")[n // 4 % 3] % (pick("23456789", 3), pick("0123456789", 3), pick("0123456789", 4))
        else:
            s = ("at noon", "about 1234 of them", "in 2023-05-17", "dot by dot", "see (at) home", "1.5 million 300 400")[n // 4 % 6]
        left = " ".join(own[:30]) + " "
        texts.append(left + s + " " + " ".join(own[30:]))
        want.append((len(left), kind, len(left) + len(s)) if kind is not None else None)
    hits, planted, wrong = {0: 0, 2: 0, 3: 0}, {0: 0, 2: 0, 3: 0}, 0
    for (base, spans), w in zip(pii.find(texts, tagger), want, strict=True):
        added = set(spans) - set(base)
        wrong += len(added - {w})
        if w and not base:
            planted[w[1]] += 1
            hits[w[1]] += w in added
    assert min(planted.values()) > 100 and wrong <= 2
    assert hits[0] > 0.85 * planted[0] and hits[2] > 0.95 * planted[2] and hits[3] > 0.95 * planted[3], hits


def test_windows_without_anchors_could_add_nothing():
    """Decoding every window of a text gives the spans that the windows around anchors give, or those at their edges."""
    tagger, rng = seeds_only(), random.Random(4)
    parts = ["word ", "at ", "dot ", "jo@x.org ", "555-0123-4444 ", "(at) ", "A", "10.1.1.1 ", "é, ", "12 ", "4111.1111.1111.1111 "]
    for _ in range(30):
        text = "".join(rng.choices(parts, [30, 3, 1, 1, 1, 1, 2, 1, 2, 2, 1], k=120))
        near = set(pii.window_starts(text))
        for s in range(0, len(text), pii.STRIDE):
            if any(s - pii.WIDTH < n < s + pii.WIDTH for n in near):
                continue
            e, _ = tagger.emissions(pii._encoded([text[s : s + pii.WIDTH]], pii.WIDTH).T)
            for a, kind, b, _ in pii.tagged_spans(tagger.decode(e)[:, 0], tagger.marginals(e)[1][:, 0], min(pii.WIDTH, len(text) - s)):
                a, b = pii._trimmed(text, kind, s + a, s + b)
                assert a == b or not pii.valid(kind, text[a:b])


def test_no_span_is_empty_or_fails_its_test():
    rng = random.Random(5)
    parts = [*"0123456789.@+-() a\u00e9_%[]", "1-2", "1.2.3.4", "255", "a@b.co", " dot ", "(at)", "+1 (234) 555-0199"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 25)))
        for kind in range(4):
            assert pii.valid(kind, text) in (True, False)
            a = rng.randint(0, len(text))
            b = rng.randint(a, len(text))
            c, d = pii._trimmed(text, kind, a, b)
            assert 0 <= c <= d <= len(text)
        found = {(a, rng.randrange(4), b): 0.95 for a, b in (sorted((rng.randint(0, len(text)), rng.randint(0, len(text)))) for _ in range(6))}
        base = pii.base_spans(text)
        out = pii.reconcile(text, base, found)
        assert set(base) <= set(out) and all(a < b and pii.valid(k, text[a:b]) for a, k, b in set(out) - set(base))
    assert not pii.valid(1, "") and not pii.valid(1, "5") and not pii.valid(1, "1-2") and pii.valid(1, "255.0.0.1")
    assert pii.reconcile("abc def", [], {(4, 1, 4): 0.95}) == []


def test_ties_take_one_of_two_equal_sets():
    text = "call 234-555-0199 now"
    assert pii.reconcile(text, [], {(5, 3, 17): 0.95, (5, 3, 16): 0.95}) in ([(5, 3, 17)], [(5, 3, 16)])
    long = "word " * 100_000 + "call (234) 555-0199 " + "word " * 100_000
    [(base, spans)] = pii.find([long], seeds_only())
    assert base == [] and spans == [(500_005, 3, 500_019)]
