import random
import re

from hourcast.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    repeat = len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)})
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat)


def test_measurements(table, edges, nothing):
    from conftest import edge_rows

    rng = random.Random(4)
    rows = [(i, rng.choice(["", "  ", "\n"]) + "".join(rng.choice(["a", "bb", "#|", "é"]) + rng.choice([" ", "\n", "\t\x0b", "\x0c\r", "\x85", "  "])
                                                       for _ in range(rng.randint(0, 40)))) for i in range(200)]
    for data, df in ((rows, table(rows)), (edge_rows(), edges)):
        got = Q.report(df).collect()
        assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted(
            (str(i), *brute(t)) for i, t, *_ in data)
        for r in got:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.kept and r.base_failed)
    assert Q.report(nothing).collect() == []


def test_policies_and_ablation(table):
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    rows = [(1, good), (2, good + " # # # # # # # # # # #"), (3, "short"), (4, "a b c " * 40), (5, "\n".join(["same line here"] * 6 + [good])),
            (6, "\n".join(["same line here", "same line here", good]))]
    book = Q.ledger(table(rows)).persist()
    kept = {v: sorted(r.doc_id for r in Q.apply_policy(book, v).where("kept").collect()) for v in Q.POLICIES}
    assert kept == {1: [1, 2, 5, 6], 2: [1, 5, 6], 3: [1], 4: [1, 6]}
    for version, policy in Q.POLICIES.items():
        for r in Q.ablation(book, version).collect():
            without = policy & ~Q.BITS[r.rule]
            assert r.documents == 6 and r.kept == len(kept[version])
            assert r.kept_without == sum(x.failed & without == 0 for x in book.collect())
            assert r.failing == sum(x.failed & Q.BITS[r.rule] != 0 for x in book.collect())


def test_no_python_in_the_plan(table):
    plan = Q.report(table([(1, "a b c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_filters_stay_above_the_arrays(table):
    """A filter on the verdict must not make Spark compute the window arrays again for each mention of it."""
    report = Q.report(table([(1, "a b c")]))
    sorts = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("sort_array")
    assert sorts(report.where("kept and n_words > 5")) == sorts(report) == 2


def test_limits_of_the_line_rules(table):
    """Repeated lines are judged from two lines on (bit 3); the looser rule asks for two repeated ones (bit 8)."""
    lines = lambda n, dup: "\n".join([f"line {i}" for i in range(n - dup)] + ["line 0"] * dup)
    cases = {(2, 1): (True, False), (3, 1): (True, False), (4, 1): (False, False), (5, 2): (True, True), (6, 2): (True, True),
             (10, 3): (False, False), (10, 4): (True, True), (1, 0): (False, False)}
    rows = [(i, lines(*c)) for i, c in enumerate(cases)]
    got = {r.doc_id: (bool(r.failed & Q.BITS["dup_lines"]), bool(r.failed & Q.BITS["several_dup_lines"])) for r in Q.ledger(table(rows)).collect()}
    assert got == dict(enumerate(cases.values()))
    assert Q.CURRENT == 3
