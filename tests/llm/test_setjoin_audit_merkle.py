"""Set join, filter audit and Merkle manifest against brute force, on hand-made and random rows."""

import hashlib
import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_small import HARD, hard  # noqa: F401

from tallymart.llm import filteraudit, merkle, setjoin

# Jaccard join


def word_sets(rows, k):
    import re

    for i, text in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        yield i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def brute_groups(rows, k, percent):
    """(id, set size, component) of rows, in order; each row is a node of its own."""
    sets = list(word_sets(rows, k))
    part = list(range(len(sets)))
    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            old, new = part[i], part[j]
            part = [new if p == old else p for p in part]
    least = {}
    for p, (i, _) in zip(part, sets):
        known = [x for x in (least.get(p), i) if x is not None]
        least[p] = min(known) if known else None
    return sorted(((i, len(s), least[p]) for p, (i, s) in zip(part, sets)), key=str)


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at] = rng.choice("uvwxyz") + str(rng.randrange(10_000))
    return words


def found_groups(spark, rows, k, percent, kind="bigint"):
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    found = setjoin.similar_groups(docs, words=k, percent=percent)
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 5, 80), (2, 2, 80), (3, 1, 60)])
def test_join_equals_brute_force(spark, seed, k, percent):
    """Families of copies with few and many edits, so that links lie on both sides of the bound, chains of them,
    a passage that all documents share, and parts of texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(12)]
    texts = []
    for _ in range(9):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((15, 40, 120)))] + passage
        texts += [edited(base, rng, rng.randrange(0, 1 + len(base) // 12)) for _ in range(8)]
        for _ in range(6):
            texts.append(edited(texts[-1], rng, 1 + len(base) // 25))
        texts += [base[: len(base) * 9 // 10], base[: len(base) // 2], base * 2]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    assert found_groups(spark, rows, k, percent) == brute_groups(rows, k, percent)


def test_answers_of_members_are_derived(spark):
    """Two leaders that are not linked, whose members are: the link follows from the leaders' answers."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    rows, n = [], 0
    for family in range(12):
        # One family on each side of a middle text, each far from the other's ends but near the middle.
        for side in ("x", "y"):
            for step in range(6):
                words = [f"{family}-{w}" for w in base]
                for j in range(3 * step):
                    words[rng.randrange(50) if side == "x" else 50 + rng.randrange(50)] = f"{family}{side}{j}"
                rows.append((n, " ".join(words)))
                n += 1
    assert found_groups(spark, rows, 1, 80) == brute_groups(rows, 1, 80)


def test_join_on_awkward_rows(spark, hard):  # noqa: F811
    rows = [(i, t) for i, t, _ in HARD]
    found = setjoin.similar_groups(hard, words=5)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_groups(rows, 5, 80)
    assert setjoin.similar_groups(hard.limit(0)).collect() == []
    named = [(f"x{i}", "a b c d e f g h i j k l m n o p q r s t u v w x y" + " z" * (i % 2)) for i in range(4)]
    assert {r[2] for r in found_groups(spark, named, 5, 80, "string")} == {"x0"}


def test_join_makes_no_pairs_of_a_group(spark, monkeypatch):
    """2,000 near copies of one text: what is compared is in proportion to them."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(edited(base, rng, 1))) for i in range(2000)]
    compared = []
    shared = setjoin.Sets.shared

    def counted(self, pairs, differences=False):
        compared.append(pairs.count())
        return shared(self, pairs, differences)

    monkeypatch.setattr(setjoin.Sets, "shared", counted)
    found = found_groups(spark, rows, 5, 80)
    assert {r[2] for r in found} == {0} and len(found) == 2000
    assert sum(compared) < 20 * 2000


def test_short_forms_bound_what_sets_share():
    """No pair that shares enough is ruled out, and most of those that share little are; sizes far apart, sets with
    equal leading bits and empty sets included."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    left, right = [], []
    for n in [0, 1, 2, 7, 40, 300, 2500] * 12:
        base = rng.sample(vocabulary, n)
        left.append(" ".join(base))
        kept = base[: int(n * rng.choice((0.1, 0.5, 0.75, 0.88, 0.95, 1)))]
        right.append(" ".join(kept + [f"v{rng.random()}" for _ in range(rng.choice((0, n // 9, n)))]) if n else "one")

    def shorts(texts):
        batch = pa.RecordBatch.from_pydict({"node": list(range(len(texts))), "text": texts})
        return [b.to_pydict() for b in setjoin.short_rows(1)(iter([batch]))][0]

    a, b = shorts(left), shorts(right)
    sets = [(set(x.split()), set(y.split())) for x, y in zip(left, right)]
    assert a["size"] == [len(x) for x, _ in sets] and b["size"] == [len(y) for _, y in sets]
    names = {"a": a["node"], "b": b["node"], "size_a": a["size"], "size_b": b["size"], "short_a": a["short"], "short_b": b["short"]}

    def kept(reach, least):
        pairs = pa.RecordBatch.from_pydict({**names, "reach": [reach] * len(sets), "least": least})
        return {i for out in setjoin.possible_rows(80)(iter([pairs])) for i in out.column(0).to_pylist()}

    sizes = [len(x) + len(y) for x, y in sets]
    linked = {i for i, (x, y) in enumerate(sets) if x and 100 * len(x & y) >= 80 * len(x | y)}
    far = {i for i, (x, y) in enumerate(sets) if 100 * len(x & y) < 70 * len(x | y)}
    found = kept(0, sizes)
    assert linked and linked <= found and len(far) > 10 and not (found & {i for i in far if sizes[i] > 100})
    reached = {i for i, (x, y) in enumerate(sets) if 180 * (len(x & y) + 5) >= 80 * sizes[i]}
    assert reached <= kept(5, sizes)


# filter audit


def brute_audit(rows, labels, failing):
    """All rows of the audit, by running every order. ``failing`` maps (id, part, text) to letters."""
    good, toxic = ({i for i, *q in labels if q[k] == 1} for k in (0, 1))
    out = {}
    for part in {p for _, p, _ in rows}:
        own = [(i, failing(i, p, t)) for i, p, t in rows if p == part]
        for order in itertools.permutations("ABCDE"):
            left, gone = list(own), []
            for step, f in enumerate(order, 1):
                lost = [r for r in left if f in r[1]]
                redundant = sum(f in r[1] for r in gone)
                left = [r for r in left if f not in r[1]]
                gone += lost
                out[part, "".join(order), step] = [
                    len(left), len(lost), redundant, sum(r[1] == f for r in own),
                    sum(r[0] in good for r in lost), sum(r[0] in toxic for r in lost),
                ]
    shapley = {}
    for (part, order, step), v in out.items():
        key = part, order[step - 1]
        shapley[key] = shapley.get(key, 0) + v[1]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_ranks_are_lexicographic():
    assert [filteraudit.lehmer_rank(o, "ABCDE") for _, o in filteraudit.orders("ABCDE")] == list(range(120))
    for mask, step, low, high, removes in filteraudit.intervals("ABC"):
        for rank, order in filteraudit.orders("ABC"):
            fails = [x for x in order if mask >> "ABC".index(x) & 1]
            here = order[step - 1] in fails
            assert not low <= rank < high or (here and removes == (order[step - 1] == fails[0]))


def test_audit_equals_brute_force(spark):
    rng = random.Random(3)
    pool = ["short text", None, "", "word " * 60, " ".join(f"w{i}" for i in range(80)), "LOUD " * 30 + " ".join(f"v{i}" for i in range(90)), "sign # " * 5]
    rows = [(i, rng.choice(("a", "b", None, "")), rng.choice(pool)) for i in rng.sample(range(1000), 150)]
    rows += [(None, "a", "short text"), (None, None, None), rows[0], rows[0]]
    labels = [(i, rng.randrange(2), rng.choice((0, 1, None))) for i, _, _ in rows[:90] if i is not None]
    labels += [(rows[0][0], 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id int, source string, text string, id int, mask string")
    made = filteraudit.audit_documents(docs, spark.createDataFrame(labels, "doc_id int, quality int, toxic int"), filteraudit.text_conditions(), "E")
    least = {}
    for i, _, t in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))

    def failing(i, part, text):
        w = text.split()
        cap = sum(c.isupper() for c in text)
        tests = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * cap > 5 * len(text), bool(set(text) & set("#$%&*|")), i is not None and least[text] < i]
        return "".join(x for x, t in zip("ABCDE", tests) if t)

    wanted = brute_audit([(i, p or "", t or "") for i, p, t in rows], [r for r in labels if r[0] is not None], failing)
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in made.collect()}
    assert found == wanted


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id int, source string, text string")
    labels = spark.createDataFrame([], "doc_id int, quality int, toxic int")
    assert filteraudit.audit_documents(docs, labels, filteraudit.text_conditions(), "E").collect() == []
    with pytest.raises(ValueError):
        filteraudit.audit(docs, "ABCDEFG")


# Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(leaves):
    """(root, witness of each leaf)."""
    level, places, witness = leaves, [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(level) > 1:
        up, held = [], []
        for i in range(0, len(level), 2):
            pair = level[i : i + 2]
            for side, own in enumerate(places[i : i + 2]):
                for p in own:
                    witness[p].append("-" if len(pair) == 1 else "RL"[side] + pair[1 - side])
            up.append(sha("".join(pair)))
            held.append(sum(places[i : i + 2], []))
        level, places = up, held
    return level[0], witness


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 13, 16, 29])
def test_appends_equal_levels(n):
    leaves = [sha(str(i)) for i in range(n)]
    subtrees = merkle.Subtrees()
    for leaf in leaves:
        subtrees.append(leaf)
    assert (subtrees.finish(None), subtrees.witness) == brute_tree(leaves)


@pytest.mark.parametrize("block", [2, 4, 1024])
def test_manifest_equals_brute_force(spark, block):
    rng = random.Random(block)
    rows = [(rng.randrange(500), rng.choice("ab" if i % 3 else "a"), f"text {i}") for i in range(150)]
    rows += [(1, None, None), (None, "c", "x"), (None, "c", "x"), (7, "é", "ü"), (8, "a", "long " * 50_000)] + rows[:3]
    docs = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id int, lang string, text string, place string, tree int")
    made = merkle.manifest(docs, ["doc_id", "lang", "text"], "lang", "doc_id", block=block)

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0], leaf(r)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        own = sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = (own, *brute_tree([x[1] for x in own]))
    root, above = brute_tree([trees[g][1] for g in names])
    wanted = [(i, h, trees[g][1], root, w + up) for g, up in zip(names, above) for (i, h), w in zip(trees[g][0], trees[g][2])]
    assert sorted(map(tuple, made.collect()), key=str) == sorted(wanted, key=str)
    folded = made.select((merkle.fold(F.col("leaf"), F.col("witness")) == F.col("root")).alias("same"))
    assert folded.filter("same").count() == len(rows)
    wrong = made.select((merkle.fold(F.sha2("leaf", 256), F.col("witness")) == F.col("root")).alias("same"))
    assert wrong.filter("same").count() == 0


def test_manifest_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id int, lang string, text string")
    assert merkle.manifest(docs, ["doc_id", "text"], "lang", "doc_id").collect() == []
