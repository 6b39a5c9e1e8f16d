import random
from itertools import combinations

from lodestone.llm.winnow import K, WINDOW, extended, fingerprints, leak_report, leaks, words_of

WORDS = [f"w{c}{i}" for i in range(40) for c in "abcdefghij"]


def test_common_form():
    a = words_of("Explain how <b>renal</b> gene-\nralised  night-time **palp­itations** &amp; ｆｕｌｌ ﬁne _and_ Café­s<br/>x")
    assert a == "explain how renal generalised nighttime palpitations full fine and cafes x".split()
    assert words_of(None) == words_of("") == words_of(" \n ") == []


def test_every_shared_span_has_a_common_fingerprint():
    r = random.Random(1)
    for _ in range(300):
        span = [r.choice(WORDS) for _ in range(K + WINDOW - 1)]
        a = [r.choice(WORDS) for _ in range(r.randint(0, 9))] + span + [r.choice(WORDS) for _ in range(r.randint(0, 9))]
        b = [r.choice(WORDS) for _ in range(r.randint(0, 9))] + span + [r.choice(WORDS) for _ in range(r.randint(0, 9))]
        assert set(fingerprints(a)[0]) & set(fingerprints(b)[0])


def edited(r, passage, share=8):
    out = []
    for i, w in enumerate(passage):
        kind = r.choice("cda") if i % share == share // 2 else ""
        out += [] if kind == "d" else [r.choice(WORDS)] if kind == "c" else [w, r.choice(WORDS)] if kind == "a" else [w]
    return out


def test_planted_passages_are_found_and_short_ones_are_not(spark):
    r = random.Random(7)
    items = [[f"i{k}x{j}" for j in range(50)] for k in range(20)]
    docs, want = [], set()
    for d in range(300):
        text = [r.choice(WORDS) for _ in range(r.randint(0, 120))]
        kind, item, at = d % 3, r.randrange(20), r.randrange(30)
        if kind == 0:
            text[5:5] = edited(r, items[item][at : at + r.randint(12, 20)])
            want.add((d, item))
        elif kind == 1:
            text[5:5] = items[item][at : at + 6]
        docs.append((d, " ".join(text)))
    docs += [(900, None), (901, ""), (902, "one two"), (0, docs[0][1]), (None, " ".join(items[3]))]
    left = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS item_id", "2 AS hash", "3 AS matched")
    right = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(99, None), (98, "")], "item_id bigint, text string").selectExpr("*", "1 AS doc_id")
    got = {(x["doc_id"], x["item_id"]) for x in leaks(left, right).collect()}
    assert got == want
    assert leaks(left, right).count() == len(want)
    assert leaks(left.limit(0), right).count() == leaks(left, right.limit(0)).count() == 0
    assert sum(x["documents"] for x in leak_report(left, right).collect()) == len(want)


def test_a_passage_counts_in_full_whatever_its_length(spark):
    item = [f"q{j}" for j in range(200)]
    changed = [w if j % 25 else "new" for j, w in enumerate(item)]
    docs = [(1, " ".join(["x y z", *item, "u v"])), (2, " ".join(["x", *changed[1:], "y"])), (3, " ".join(item[90:110]))]
    left, right = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(5, " ".join(item))], "item_id bigint, text string")
    assert {x["doc_id"]: x["matched"] for x in leaks(left, right).collect()} == {1: 200, 2: 192, 3: 20}
    assert [tuple(x) for x in leak_report(left, right).collect()] == [(5, 3, 200)]


def brute(doc, item):
    """Longest passage by trying each pair of equal words as its start and one with all edits."""
    best, n, m = 0, len(doc), len(item)
    for i in range(n):
        for j in range(m):
            if doc[i] != item[j]:
                continue
            layer = {(i, j): 0}
            for e in range(m // 3 + 1):
                nxt = {}
                todo = dict(layer)
                while todo:
                    (a, b), kept = todo.popitem()
                    if a < n and b < m and doc[a] == item[b] and kept + 1 > todo.get((a + 1, b + 1), -1):
                        todo[a + 1, b + 1] = kept + 1
                    if kept >= 3 * e:
                        best = max(best, kept)
                    for at in ((a + 1, b + 1), (a + 1, b), (a, b + 1)):
                        if at[0] <= n and at[1] <= m and kept > nxt.get(at, -1):
                            nxt[at] = kept
                layer = nxt
    return best if best >= 9 else 0


def test_equal_to_brute_force_on_everyday_words(spark):
    r = random.Random(3)
    common = [f"c{i}" for i in range(12)]
    items = [[r.choice(common) if r.random() < 0.3 else f"i{k}x{j}" for j in range(24)] for k in range(8)]
    docs = []
    for d in range(60):
        text = [r.choice(common) for _ in range(10)]
        item, at = r.randrange(8), r.randrange(8)
        docs.append(text[:5] + edited(r, items[item][at : at + r.randint(12, 16)]) + text[5:] if d % 2 else text + items[item][at : at + 5])
    left = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id bigint, text string")
    right = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id bigint, text string")
    want = {(d, k, n) for d, w in enumerate(docs) for k, it in enumerate(items) if (n := brute(w, it))}
    assert {tuple(x) for x in leaks(left, right).collect()} == want and len(want) >= 25


def test_extension_counts_kept_words():
    item = [f"i{j}" for j in range(30)]
    doc = item[:10] + ["new"] + item[11:25]
    assert extended(doc, item, 3, 3) >= 20
    assert extended(item[:6] + ["x"] * 20, item, 1, 1) < 9


def test_a_passage_deep_in_a_long_text(spark):
    item = " ".join(f"q{j}" for j in range(14))
    df = spark.createDataFrame([(1, "filler word " * 100_000 + item)], "doc_id bigint, text string")
    assert leaks(df, spark.createDataFrame([(5, item)], "item_id bigint, text string")).first()["item_id"] == 5


def test_no_placement_of_edits_loses_a_passage():
    for n in range(12, 21):
        item = [f"i{j}" for j in range(n)]
        for places in combinations(range(1, n - 1), round(n / 8)):
            for kind in ("changed", "missing", "added"):
                doc = ["a", "b", "c"]
                for j, w in enumerate(item):
                    doc += [w] if j not in places else {"changed": ["new"], "missing": [], "added": ["new", w]}[kind]
                doc += ["y", "z"]
                theirs = dict(zip(*fingerprints(item)))
                hits = [(at, theirs[h]) for h, at in zip(*fingerprints(doc)) if h in theirs]
                kept = n if kind == "added" else n - len(places)
                assert max(extended(doc, item, *h) for h in hits) == kept, (n, places, kind)


def test_six_shared_words_stay_no_leak_beside_chance_words():
    item = [f"i{j}" for j in range(30)]
    assert extended(["x", *item[10:16], "y", item[17], "z", "q", "r", item[20]], item, 1, 10) == 0
