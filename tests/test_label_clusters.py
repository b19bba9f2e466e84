import random
import re
from collections import Counter

from quarry.operators.label_clusters import clusters


def edits(a, b):
    """Edit distance, by the table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(diagonal + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def by_hand(labels, least):
    counts = Counter(x for x in labels if x is not None)
    text = {x: re.sub(r"\s+", " ", x.lower()).strip(" ") for x in counts}
    mark = {x: " ".join(sorted(set(re.findall(r"[^\W_]+", x.lower())))) for x in counts}
    known = [x for x in counts if mark[x]]
    root = {x: x for x in known}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in known:
        for b in known:
            near = least and min(len(text[a]), len(text[b])) >= least and abs(len(text[a]) - len(text[b])) <= 1 and edits(
                text[a], text[b]) <= 1
            if mark[a] == mark[b] or near:
                root[find(a)] = find(b)
    groups = {}
    for x in known:
        groups.setdefault(find(x), []).append(x)
    out = []
    for g in groups.values():
        name = min(g, key=lambda x: (-counts[x], x))
        out += [(x, counts[x], name, len(g), sum(counts[y] for y in g)) for x in g]
    return sorted(out)


def found(spark, labels, least):
    df = spark.createDataFrame([(x,) for x in labels], "breed string")
    return sorted(map(tuple, clusters(df, "breed", least).collect()))


def test_spellings_of_one_label(spark):
    labels = ["Beagle Mix", "Beagle Mix", "Beagle- Mix", "beagle  mix", "Mix, Beagle", "Beagel Mix", "Beagles Mix", "Poodle",
              "Poodle", "Podle", "Noodle", "Pug", "Pig", None, "", "--", "aab", "baa", "Shih Tzu", "shih-tzu", "ß é", "É ß"]
    for least in (0, 1, 5):
        assert found(spark, labels, least) == by_hand(labels, least)
    named = {r[0]: r[2] for r in found(spark, labels, 5)}
    assert named["Beagle- Mix"] == named["Mix, Beagle"] == named["Beagles Mix"] == "Beagle Mix"
    assert named["Pug"] == "Pug" and "" not in named


def test_random_labels_against_all_pairs(spark):
    rng = random.Random(6)
    labels = ["".join(rng.choice("ab -") for _ in range(rng.randrange(9))) for _ in range(150)]
    labels += ["Customer#%09d" % i for i in range(60)]  # one long common beginning, one chain
    labels += [x + "x" * i for i in range(12) for x in ("chain",)]
    assert found(spark, labels, 3) == by_hand(labels, 3)


def test_empty(spark):
    assert found(spark, [], 5) == found(spark, [None, "."], 5) == []
