import hashlib
import random

from conftest_llm import ODD, rows_of

from fieldtrail.llm.exact import exact_groups


def expected(rows):
    """doc_id -> result rows, by comparing whole texts."""
    bare = [(i, t or "", "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")) for i, t in rows]
    out = []
    for i, t, b in bare:
        same = [(-len(u), j is None, j or 0, j) for j, u, c in bare if c == b]
        out.append((i, min(same)[3], len(same), hashlib.sha256(b.encode()).hexdigest()))
    return sorted(out, key=str)


def check(made, rows):
    got = rows_of(made)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected(rows)
    groups = {}
    for r in got:
        groups.setdefault(r.text_sha256, []).append(r.kept)
        assert not r.kept or r.doc_id == r.keep_id
    assert all(sum(kept) == 1 for kept in groups.values())


def test_odd_rows(odd_docs, no_docs):
    check(exact_groups(odd_docs), ODD)
    assert rows_of(exact_groups(no_docs)) == []


def test_blocks_that_differ_late_or_in_length(make_docs):
    rng = random.Random(1)
    base = "".join(rng.choice("ab ") for _ in range(900))
    rows = [(i, base[: rng.choice([899, 900])] + rng.choice(["", "", "x", " x", "xx"])) for i in range(60)]
    rows += [(100 + i, base[:64] * k) for i, k in enumerate([1, 2, 3, 4, 5, 5, 8, 16, 16])]
    # A block size this small gives several levels of pairs.
    check(exact_groups(make_docs(rows), block=16), rows)


def test_longest_original_stays(make_docs):
    got = rows_of(exact_groups(make_docs([(3, "ab"), (2, "a b"), (1, "ab "), (4, "ab")])))
    assert {r.keep_id for r in got} == {1} and {r.group_size for r in got} == {4}
