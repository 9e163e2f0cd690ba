import hashlib
import random
from collections import Counter

import pytest

from starpipe.llm import repeat_tree
from starpipe.llm.queries import op9_interval_tree
from tests.llm.conftest import SF


def brute(texts, length=400):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) by counting every string of ``length`` bytes."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        rest = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def got(rows):
    return sorted(((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows.collect()), key=str)


def want(rows, length):
    return sorted(((k, *x) for (k, _), x in zip(rows, brute([t for _, t in rows], length), strict=True)), key=str)


def test_query_against_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op9_interval_tree(spark, SF).collect()]
    assert sorted(found, key=str) == want(rows, 400)
    assert 0 < sum(x[2] for x in found) < sum(x[1] for x in found)


def _rows(seed):
    rng = random.Random(seed)

    def prose(n):
        return "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passages = [prose(rng.randrange(45, 160)) for _ in range(6)]
    rows = [(i, "".join(rng.choice([prose(rng.randrange(0, 90)), rng.choice(passages)]) for _ in range(rng.randrange(1, 6))))
            for i in range(50)]
    line = prose(70)
    rows += [(100 + i, prose(20) + line + prose(25)) for i in range(30)]                  # one common line
    rows += [(200, "a" * 500), (201, "ab" * 100), (202, "a" * 90), (203, prose(30) + "a" * 120)]  # periods
    rows += [(300, None), (301, ""), (302, "short"), (303, rows[0][1]), (303, rows[0][1]), (None, rows[3][1])]
    return rows


@pytest.mark.parametrize(("seed", "crowd"), [(1, 2000), (2, 0), (3, 5)])
def test_random_texts(make_docs, seed, crowd):
    rows = _rows(seed)
    assert got(repeat_tree.remove_repeats(make_docs(rows), length=40, gram=8, crowd=crowd)) == want(rows, 40)


def test_pieces_of_a_long_text(monkeypatch):
    data = bytes(random.Random(5).choice(b"abcd") for _ in range(5000))
    whole = repeat_tree.anchors_of(data, 40, 8)
    monkeypatch.setattr(repeat_tree, "PIECE", 300)
    cut = repeat_tree.anchors_of(data, 40, 8)
    assert cut[0].tolist() == whole[0].tolist() and cut[1].tolist() == whole[1].tolist()
    gaps = [b - a for a, b in zip(whole[0].tolist(), whole[0].tolist()[1:], strict=False)]
    assert max(gaps) <= 40 - 8 + 1 and whole[0][0] <= 40 - 8


def test_intervals_and_maximal_repeats():
    words = sorted([b"banana", b"anana", b"nana", b"ana", b"na", b"a"])
    lcp = [repeat_tree.common(a, b) for a, b in zip(words, words[1:], strict=False)]
    found = list(repeat_tree.intervals(lcp))
    assert {(p, words[a][:p]) for p, a, b in found if p} == {(3, b"ana"), (1, b"a"), (2, b"na")}
    for p, a, b in found:
        inside = [w for w in words if w[:p] == words[a][:p]]
        assert inside == words[a:b + 1]
    # every occurrence is a member, not only neighbours
    sides = sorted((x + bytes([i]), b"XYZ" + bytes([i])) for i, x in enumerate([b"same", b"same", b"same", b"other"]))
    groups = [m for _, p, m in repeat_tree.maximal_repeats(sides, 5) if p == 4]
    assert [len(m) for m in groups] == [3]


def test_empty_table(make_docs):
    assert repeat_tree.remove_repeats(make_docs([(1, "a")]).limit(0)).collect() == []


def test_kept_bytes(make_docs):
    text = "x" + "0123456789" * 5
    rows = repeat_tree.remove_repeats(make_docs([(1, "left " + text), (2, text + " right")]), length=20, gram=8, with_kept=True)
    assert {r["id"]: bytes(r["kept"]) for r in rows.collect()} == {1: b"left ", 2: b" right"}


def brute_groups(rows, length, gram):
    """{(n_bytes, its occurrences as (id, text, start))} for each string of ``length`` bytes that repeats
    before different bytes, extended to the left until its occurrences differ or the anchor's context ends."""
    places = {}
    for number, (_, t) in enumerate(rows):
        d = (t or "").encode()
        for i in range(len(d) - length + 1):
            places.setdefault(d[i:i + length], []).append((number, i))
    data, out = [(t or "").encode() for _, t in rows], []
    for w, at in places.items():
        following = [data[k][i + length:i + length + 1] for k, i in at]
        if len(at) < 2 or (len(set(following)) == 1 and following[0]):
            continue
        most, more = length - gram - int(repeat_tree.anchors_of(w, length, gram)[0][0]), 0
        while more < most and all(i > more for _, i in at) and len({data[k][i - more - 1] for k, i in at}) == 1:
            more += 1
        out.append((length + more, sorted((str(rows[k][0]), i - more) for k, i in at)))
    return sorted(out)


@pytest.mark.parametrize(("seed", "crowd"), [(1, 2000), (2, 0), (3, 5)])
def test_groups_of_maximal_repeats(make_docs, seed, crowd):
    rows = _rows(seed)
    found = {}
    for r in repeat_tree.repeat_groups(make_docs(rows), length=40, gram=8, crowd=crowd).collect():
        found.setdefault(r["repeat"], []).append(r)
    assert all({x["n_occurrences"] for x in of} == {len(of)} and len({x["n_bytes"] for x in of}) == 1 for of in found.values())
    got_groups = sorted((of[0]["n_bytes"], sorted((str(x["id"]), x["start"]) for x in of)) for of in found.values())
    assert got_groups == brute_groups(rows, 40, 8)
    assert max(len(x[1]) for x in got_groups) > 25


def test_groups_of_an_empty_table(make_docs):
    assert repeat_tree.repeat_groups(make_docs([(1, "a")]).limit(0)).collect() == []
