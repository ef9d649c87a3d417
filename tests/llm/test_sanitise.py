import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import sanitise

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DOCS = "doc_id long, text string, spans string, near string, _pii_row long"


def luhn(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    out = []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": name != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[name]
            if good:
                out.append((kind, *m.span()))
    return out


@pytest.mark.parametrize(
    "text",
    [None, "", "a@b.c@d.e", "@a.b@c.d", "a@b@c.d", "x a.@b.c.", "a@b.c.@d.ef", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.255", "4465758382889437 4465 7583 8288 9437",
     "é +1 (743) 555-3824, +12 3", "+1+12345678901", "4111-1111-1111-1111 1", "0" * 16, "中a@b.cd 8.8.8.8"],
)
def test_base_spans(text):
    assert sanitise.base_spans(text) == plain(text)


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from(list("ab@@..-+ 0123459()é")), max_size=50))
def test_base_spans_on_mixed_text(text):
    assert sanitise.base_spans(text) == plain(text)


def test_long_texts_take_linear_time():
    for part in ("a", "a@", "1", "1.", "+1 ", "1-", "@a.", "a@b."):
        sanitise.base_spans(part * 300_000)


def test_places_of_terms():
    texts = ["É ab_cd über  x", "", "中文中文中文 " + "q" * 70]
    terms = sanitise.Terms(pa.array(texts))
    found = [(r, texts[r][a:b].lower()) for r, a, b in zip(terms.rows.tolist(), terms.starts.tolist(), terms.ends.tolist(), strict=True)]
    assert found == [(0, "é"), (0, "ab"), (0, "cd"), (0, "über"), (0, "x"), (2, "中文中文中文"), (2, "q" * 70)]
    assert [bool(s) for s in terms.stems] == [False] * 5 + [True, True]
    assert len(set(terms.numbers.tolist())) == 7


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [(m.start(), m.end(), m[0]) for m in WORD.finditer(low)]


def plain_added(texts):
    """Added spans of each text, with strings in place of numbers."""

    def stem(w):
        return w[: sanitise.STEM] + "*" if len(w) >= sanitise.STEMMED else None

    has, both, sides, owns = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    outside = []
    for n, text in enumerate(texts):
        text = text or ""
        base = plain(text)
        for _, _, w in words(text):
            has[w].add(n)
            if stem(w):
                has[stem(w)].add(n)
        free = [w for w in words(text) if all(w[1] <= a or w[0] >= b for _, a, b in base)]
        outside.append(free)
        first = {}
        for kind, a, b in sorted(base, key=lambda s: s[1]):
            entity = sanitise.value_of(kind, text[a:b])
            owns[entity].add(n)
            left, right = [w[2] for w in free if w[1] <= a], [w[2] for w in free if w[0] >= b]
            first.setdefault(entity, (tuple(left[-sanitise.NEIGHBOURS :]), tuple(right[: sanitise.NEIGHBOURS])))
            for w in left[-sanitise.WINDOW :] + right[: sanitise.WINDOW]:
                for t in (w, stem(w)):
                    if t:
                        both[entity, t].add(n)
                        sides[entity, t].add(first[entity])
    flagged = set()
    for (entity, t), docs in both.items():
        if min(len({s[i] for s in sides[entity, t]}) for i in (0, 1)) < sanitise.MIN_CONTEXTS:
            continue
        p = len(owns[entity]) / len(texts)
        content, shared = -math.log2(p), math.log2(len(docs) / len(has[t]) / p)
        if content > 0 and shared >= sanitise.DISCLOSURE * content:
            flagged.add((entity, t))
    out = []
    for n, free in enumerate(outside):
        mine = [e for e in owns if n in owns[e]]
        spans = []
        for a, b, w in free:
            kinds = [4 if stem(w) and (e, stem(w)) not in flagged else 5 for e in mine if (e, w) in flagged]
            if kinds:
                spans.append((max(kinds), a, b))
        out.append(sorted(spans))
    return out


def corpus():
    rng = np.random.default_rng(7)
    filler = [f"w{'abcdefghij'[i % 10]}{i}" for i in range(300)]
    texts = []

    def prose(n):
        return " ".join(filler[i] for i in rng.integers(0, 300, n))

    for i in range(400):
        texts.append(prose(30))
        if i % 40 == 0:
            texts.append(f"{prose(12)} Kowalski zq of {prose(1)} Kowalski@Mail.example.com {prose(2)} Brennofen {prose(10)} kowalski.")
        if i % 60 == 0:
            texts.append(f"{prose(9)} Brennstoff tel {prose(1)} +1 (743) 555-3824 {prose(9)}")
    texts += [texts[1]] * 5
    # One passage copied many times is no evidence.
    texts += ["unique passage words zyx 8.8.8.8 and its Rarities " + prose(5) for _ in range(20)]
    return texts + [None, "", "brennen Brenner brenne " * 3, "a@b.cd"]


def test_added_spans_are_those_of_the_definition(spark):
    texts = corpus()
    expected = plain_added(texts)
    rows = [(i, t, "x", None, 3) for i, t in enumerate(texts)]
    found = {r.doc_id: r for r in sanitise.find(spark.createDataFrame(rows, DOCS).repartition(6)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        base = sanitise.spelled(plain(text))
        assert found[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert found[i].spans == ",".join(filter(None, [base, sanitise.spelled(expected[i])]))
    told = {texts[i][a:b].lower() for i, spans in enumerate(expected) for _, a, b in spans}
    assert {"kowalski", "zq", "brennofen"} <= told and not {"rarities", "passage", "wa0"} & told
    kinds = {(k, texts[i][a:b].lower()) for i, spans in enumerate(expected) for k, a, b in spans}
    assert (4, "brennofen") in kinds and (5, "kowalski") in kinds


def test_masked_texts(spark):
    texts = corpus()
    rows = [(i, t, "x", None, 3) for i, t in enumerate(texts)]
    found = {r.doc_id: r.text for r in sanitise.sanitise(spark.createDataFrame(rows, DOCS)).collect()}
    private = [i for i, t in enumerate(texts) if t and plain(t)]
    for i, t in enumerate(texts):
        assert found[i] == (t or "") or i in private
    assert "Kowalski" not in found[1] and "[removed]" in found[1] and "bre" in found[1].lower() and "[email]" in found[1]
    assert sanitise.masked("ab cd ef", [(0, 0, 4), (3, 3, 5), (4, 6, 8)], 1) == "[email] e…"


def test_rows_of_any_kind(spark):
    rows = [(None, "x 8.8.8.8", "", "", 0), (1, None, "", "", 0), (2, "a@b.cd " * 30_000, "", "", 0), (2, "", None, None, None)]
    found = sanitise.find(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.n_ip) for r in found) == [(0, 0, 1), (1, 0, 0), (2, 0, 0), (2, 30_000, 0)]
    assert sanitise.find(spark.createDataFrame([], DOCS)).collect() == []
