import hashlib
import random
import re
import string

from hourcast.llm import secret_scan as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


LIVE = "gh9Kx2Lm4Pq8Rt6Vw1Zy3Bn5"
ROWS = [
    (1, "é PASSWORD = 'hunter22' and token:abc secret=token:abcdefgh", "en", "a"),
    (2, "AKIA" + "Q" * 16 + " AKIAQQ AKIA" + "A1" * 20, "en", "a"),
    (3, "0123456789abcdef01234567 0123456789abcdef0123456 " + "ab" * 40, "en", "b"),
    (4, "x api_key=" + LIVE, "en", "a"), (5, "x " + LIVE + " tail", "en", "a"), (6, "plain " + LIVE[::-1], "en", "c"),
    (7, "shared " + "zK4mN8pQ2rT6vX9yB3cD", "en", "a"), (8, "shared zK4mN8pQ2rT6vX9yB3cD", "en", "b"), (9, "zK4mN8pQ2rT6vX9yB3cD", "en", None),
    (10, "passwoſrd=abcdefgh toKen=abcdefgh apikey==abcdefg", "en", "d"),
]


def test_base_spans(table, edges):
    from conftest import edge_rows

    for rows, df in ((ROWS, table(ROWS)), (edge_rows(), edges)):
        want = sorted((i, hashlib.sha256(",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in base(t)).encode()).hexdigest()) for i, t, *_ in rows if i is not None)
        got = S.report(df).collect()
        assert sorted((r.doc_id, r.base_sha256) for r in got if r.doc_id is not None) == want
        assert len(got) == len(rows)


def test_counts_and_added_spans(table):
    got = {r.doc_id: r for r in S.report(table(ROWS)).collect()}
    assert (got[1].n_assign, got[2].n_access, got[3].n_hex) == (1, 2, 2)
    assert got[6].spans == f"generic:6:{6 + len(LIVE)}" and got[6].n_live == 1
    assert got[7].spans == got[8].spans == got[9].spans == ""  # three owners: a copied example


def test_ownership_counts(table):
    rows = S.ownership(S.scan(table(ROWS + [ROWS[6]]))).collect()
    found = {(r.n_documents, r.n_owners, r.status) for r in rows}
    assert (3, 3, "example") in found  # the repeated row is one document
    assert (2, 1, "live") in found


def test_redact(table, edges, nothing):
    df = table(ROWS)
    out = S.redact(df)
    assert out.columns == df.columns
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[6] == "plain [SECRET]" and text[8] == ROWS[7][1] and "hunter22" not in text[1]
    assert out.select("row_key", "value").distinct().collect() == df.select("row_key", "value").distinct().collect()
    assert S.redact(edges).count() == edges.count()
    assert S.redact(nothing).collect() == [] and S.report(nothing).collect() == []


def test_long_tokens_are_found(table):
    """Session tokens, one-line keys and payloads have any length; a placeholder word in thousands of characters is chance."""
    rng = random.Random(6)
    run = lambda n: "".join(rng.choice(string.ascii_letters + string.digits + "+/_-") for _ in range(n))
    tokens = {1: run(129), 2: run(400), 3: run(3000) + "test" + run(3000)}
    rows = [(i, f"a {t} z", "en", "a") for i, t in tokens.items()] + [(4, "a " + "zy12" * 100 + " z", "en", "a")]
    got = {r.doc_id: r.spans for r in S.report(table(rows)).collect()}
    assert got == {**{i: f"generic:2:{2 + len(t)}" for i, t in tokens.items()}, 4: ""}
    text = {r.doc_id: r.text for r in S.redact(table(rows)).collect()}
    assert text == {1: "a [SECRET] z", 2: "a [SECRET] z", 3: "a [SECRET] z", 4: rows[3][1]}


def test_documents_decide_between_two_owners(table):
    """A value of two owners is a leak in few documents and a copied example in many; a single owner's stays live in any number."""
    few, many, own = "zK4mN8pQ2rT6vX9yB3cD", "aH7jL1kP5sW9dF3gZ8xC", "qU2wE6rT0yI4oP8aS1dG"
    rows = [(i, f"a {few} z", "en", "ab"[i % 2]) for i in range(4)]
    rows += [(100 + i, f"a {many} z token={many}", "en", "ab"[i % 2]) for i in range(S.MIN_COPIES)]
    rows += [(200 + i, f"a {own} z", "en", "a") for i in range(3 * S.MIN_COPIES)]
    got = {r.doc_id: r for r in S.report(table(rows)).collect()}
    assert all(got[i].spans == "generic:2:22" and got[i].n_live == 1 for i in range(4))
    assert all(got[i].spans == f"assign:25:{25 + 6 + len(many)}" and got[i].n_example == 1 for i in range(100, 100 + S.MIN_COPIES))
    assert all(got[i].n_live == 1 for i in range(200, 200 + 3 * S.MIN_COPIES))
    text = {r.doc_id: r.text for r in S.redact(table(rows)).collect()}
    assert text[0] == "a [SECRET] z" and many in text[100] and "[SECRET]" in text[200]


def test_placeholder_words_count_by_their_share():
    run = "q7Wz1Lk9Vb3Xn5Rt8Yp2Mc4Jh6Gd0Fs"
    assert S.looks_live(run) and not S.looks_live(run[:20] + "example" + run[:5])
    assert not S.looks_live((run * 2)[:60] + "test") and S.looks_live((run * 2)[:61] + "test") and not S.looks_live(run * 4 + "example_example")
    assert S.looks_live(run * 100 + "test")


def test_columns_with_helper_names(clashing, edges):
    out = S.redact(clashing)
    assert out.columns == clashing.columns
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, S.redact(edges).select("doc_id", "text").collect()))
    assert out.select(*clashing.columns[4:]).distinct().count() == 1
