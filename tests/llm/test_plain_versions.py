"""Language models and linked secrets against plain versions of their descriptions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from skyledger.llm import credentials, language
from skyledger.llm.credentials import KINDS, SCOPE

# --- Kneser-Ney


def symbols(text):
    kept = [c if c.isalpha() else " " for c in text.lower()]
    result = ["^", "^", "^", " "]
    for c in kept:
        if c != " " or result[-1] != " ":
            result.append(c)
    return result


def grams(text):
    s = symbols(text)
    return [tuple(s[k - 3 : k + 1]) for k in range(3, len(s))]


class PlainModel:
    """Interpolated Kneser-Ney by its formula, with dictionaries."""

    def __init__(self, texts, alphabet):
        counts = Counter(g for t in texts for g in grams(t))
        self.alphabet, self.levels = alphabet, {}
        for order in (4, 3, 2, 1):
            if order < 4:  # the ways in which an n-gram is continued to the left
                counts = Counter(g[1:] for g in counts)
            once, twice = (sum(c == n for c in counts.values()) for n in (1, 2))
            discount = once / (once + 2 * twice) if once and twice else 0.5
            total, kinds = Counter(), Counter()
            for g, c in counts.items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            self.levels[order] = counts, discount, total, kinds

    def p(self, gram):
        if not gram:
            return 1 / self.alphabet
        counts, discount, total, kinds = self.levels[len(gram)]
        below = self.p(gram[1:])
        context = gram[:-1]
        if not total[context]:
            return below
        share = max(counts[gram] - discount, 0) / total[context]
        return share + discount * kinds[context] / total[context] * below

    def cross_entropy(self, text):
        own = grams(text)
        return -sum(math.log(self.p(g)) for g in own) / len(own)


def test_cross_entropy_is_that_of_kneser_ney(spark):
    r = random.Random(2)
    letters = {"a": "abcdefgh ", "b": "efghijkl ,", "c": "äöüabz  "}
    texts = {k: ["".join(r.choices(v, k=r.randint(0, 200))) for _ in range(40)] for k, v in letters.items()}
    rows = [(i, t, k) for k, own in texts.items() for i, t in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = language.build_model(language._collected(language.gram_counts(docs)))
    seen = {g[-1] for own in texts.values() for t in own for g in grams(t)}
    plain = {k: PlainModel(own, len(seen) + 1) for k, own in texts.items()}
    asked = ["abc def", "", "xyz!", "äöü efg 123 hij", "Ünïcode 日本", "a" * 50]
    asked += ["".join(r.choices("abcdefghijklöz xyq", k=60)) for _ in range(50)]
    found, _, _ = model.cross_entropy(asked)
    expected = [[plain[k].cross_entropy(t) for k in model.languages] for t in asked]
    assert np.allclose(found, expected, rtol=1e-9)
    # the prediction is the language with the least of them
    names, _, least, _ = model.predict(asked)
    for text, name, entropy, row in zip(asked, names, least, expected, strict=True):
        if any(c.isalpha() for c in text):
            assert row[model.languages.index(name)] == pytest.approx(min(row))
            assert entropy == pytest.approx(min(row))
        else:
            assert name == "und"


# --- linked secrets


def plain_spans(text):
    """(start, kind, stop) of strong matches and of weak ones whose complements stand near."""
    found = []
    for number, kind in enumerate(KINDS):
        for m in re.finditer(kind.pattern, text, re.ASCII):
            if len(m[kind.group]) >= kind.least:
                found.append((m.start(), number, m.end()))
    strong = [s for s in found if not KINDS[s[1]].weak]
    result = list(strong)
    for start, number, stop in found:
        kind = KINDS[number]
        if not kind.weak or any(a < stop and b > start for a, _, b in strong):
            continue
        near = {KINDS[k].role for a, k, b in found if a < stop + SCOPE and b > start - SCOPE}
        needed = {"identifier": {"secret"}, "secret": {"identifier"}}
        if needed.get(kind.role, {"identifier", "secret"}) <= near:
            result.append((start, number, stop))
    return sorted(result)


def test_links_equal_those_of_a_plain_search(spark):
    r = random.Random(12)

    def value():
        alphabet = "ABCDEFGHIJabcdefghij0123456789" + r.choice(["", "+/", "-_"])
        return "".join(r.choices(alphabet, k=r.randint(15, 90))) + r.choice(["", "="])

    def part():
        return r.choice(
            [
                lambda: f"user: {value()[:6]}", lambda: "client_id='web-1'", value, value,
                lambda: f"https://db{r.randint(1, 9)}.example.org/x", lambda: "redis://cache:6379/0",
                lambda: f"password={value()}", lambda: "AKIA" + "A1B2C3D4E5F6G7H8I9",
                lambda: "0123456789abcdef" * 2, lambda: "é" * r.randint(1, 300),
                lambda: "word " * r.randint(1, 70),
            ]
        )()

    rows = [(i, " ".join(part() for _ in range(r.randint(0, 14)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {
        row.doc_id: sorted((s.start, s.kind, s.stop) for s in row.found)
        for row in credentials.scan(docs).collect()
    }
    kinds = defaultdict(int)
    for i, text in rows:
        expected = plain_spans(text)
        assert found[i] == expected, text
        for _, kind, _ in expected:
            kinds[kind] += 1
    assert all(kinds[k] > 20 for k in range(len(KINDS)))
