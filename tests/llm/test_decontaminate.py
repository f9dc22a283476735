import hashlib
import random
import re

from hourcast.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, items, width=13, share=20):
    windows = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        n = min(width, len(w))
        if n and i is not None:
            for k in range(len(w) - n + 1):
                windows.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    sizes = {len(w) for w in windows}
    out = []
    for i, t, *_ in rows:
        w, hit, found = WORD.findall((t or "").translate(LOWER)), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and share * len(hit) >= len(w)))
    return sorted(out)


def data(seed=8):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Alpha", "beta", "gamma7", "été", "X"]) + str(rng.randint(0, 9))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 5, 12, 13, 14, 30])))) for i in range(20)]
    items += [(3, items[3][1]), (77, None), (78, "..."), (None, items[1][1] + " tail words here")]
    rows = []
    for i in range(120):
        w = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            w[len(w) // 2:len(w) // 2] = items[rng.randrange(20)][1].split()[:rng.choice([8, 13, 40])]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    return rows, items


def make(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def got(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def test_equals_brute_force(spark, table):
    rows, items = data()
    want = brute(rows, items)
    assert got(D.report(table(rows), make(spark, items))) == want
    assert any(r[2] for r in want)
    assert got(D.report(table(rows + rows[:5]), make(spark, items), max_windows=30)) == sorted(want + brute(rows[:5], items))


def test_removal(spark, table):
    rows, items = data()
    bad = {r[0] for r in brute(rows, items) if r[5]}
    df, bench = table(rows), make(spark, items)
    for kept in (D.remove_documents(df, bench), D.remove_documents(df, bench, max_windows=30)):
        assert kept.columns == df.columns
        assert {str(r.doc_id) for r in kept.collect()} == {str(i) for i, _ in rows} - bad
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    cut = D.remove_spans(table([(1, f"Keep this. {item.upper()}! And this"), (2, "clean")]), make(spark, [(1, item)]))
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "Keep this. ! And this", 2: "clean"}


def test_edges(spark, edges, nothing):
    from conftest import edge_rows

    items = [(1, "no id at all"), (2, "été über 中文"), (3, "")]
    assert got(D.report(edges, make(spark, items))) == brute(edge_rows(), items)
    assert got(D.report(edges, make(spark, []))) == brute(edge_rows(), [])
    assert D.report(nothing, make(spark, items)).collect() == []


def test_slices_hold_both_bounds(spark, table):
    """Items that share one window are dealt over slices, and long words count by their bytes."""
    item = " ".join(f"w{i}" for i in range(13))
    shared = make(spark, [(i, item) for i in range(60)])
    assert all(s.count() <= 10 for s in D._slices(shared, 13, 10))
    rows = [(1, "x " + item + " y"), (2, "none"), (3, None)]
    items = [(i, item) for i in range(60)]
    assert got(D.report(table(rows), shared, max_windows=10)) == brute(rows, items)
    wide = [(i, f"{i}" + "中" * 3000) for i in range(12)]
    sizes = [sum(len(r["window"]) + len(r["item_id"]) for r in s.collect()) for s in D._slices(make(spark, wide), 13, 1000, 30_000)]
    assert max(sizes) <= 30_000 and sum(sizes) > 100_000


def test_remove_spans_of_any_benchmark(spark, table):
    """A benchmark of several slices is cut out of the same places as one that fits."""
    rows, items = data()
    rows = rows + rows[:3] + [(None, rows[7][1]), (500, None), (501, "É " + items[1][1].upper() + "!")]
    assert len(D._slices(make(spark, items), 13, 30)) > 1
    want, cut = (sorted((str(r.doc_id), str(r.text)) for r in D.remove_spans(table(rows), make(spark, items), max_windows=n).collect()) for n in (1 << 19, 30))
    assert cut == want and want != sorted((str(i), str(t)) for i, t in rows)
