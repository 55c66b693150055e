"""Small tables with the awkward cases that every operator has to bear, and plain versions of what operators compute."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
#: Columns that no operator may trip over.
CLASHES = (
    "size", "key", "h", "weight", "node", "block", "bucket", "n", "target", "kept", "band", "root", "word", "bytes", "rows", "shard",
    "length", "piece", "rank", "ids", "task", "of", "head", "of_lang", "words", "prefix", "__q", "__d", "__ref", "__common", "__common_of", "__kept",
    "__bytes", "__removed", "__spans", "__sha256", "__mix", "__mix_h", "__mix_times", "__mix_copy", "__key", "__chars", "a`b", "a.b",
)


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, lang="en"):
    stems = {"en": ["the", "of", "and", "tion", "er", "in"], "fr": ["le", "de", "é", "que", "ment", "eau"]}[lang]
    out = []
    for _ in range(n):
        w = rng.choice(stems[:3]) if rng.random() < 0.4 else "".join(rng.choice(stems) for _ in range(rng.randint(2, 5)))
        out.append(w + (".\n" if rng.random() < 0.08 else ""))
    return " ".join(out)


def documents():
    """(doc_id, text, lang, source) with copies, near copies, shared passages, ties, nulls, empty and very long texts."""
    rng = random.Random(7)
    passage = prose(rng, 60)
    base = [prose(rng, rng.randint(30, 400)) for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(20 + i, prose(rng, 200, "fr"), "fr", None) for i in range(8)]
    rows += [(40, base[0], "en", "s0"), (41, base[0], "en", "s1"), (42, base[1], None, "s1")]  # exact copies
    for i, k in enumerate((3, 4, 5)):  # near copies: one word in fifty is another
        w = base[k].split(" ")
        rows.append((50 + i, " ".join("zz" if j % 50 == 25 else x for j, x in enumerate(w)), "en", "s2"))
    rows += [(60 + i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}", "en", "s0") for i in range(4)]
    rows += [(70, None, "en", "s0"), (71, "", "en", None), (72, " \n\t ", "en", "s1"), (73, "one", "xx", "s1"), (74, "one two", "en", "ß")]
    rows += [(80, "é" * 40 + passage[:60], "fr", "s0"), (81, "è" + "é" * 40, "fr", "s0")]
    rows += [(None, passage, "en", None), (None, base[2], "en", "s0"), (None, None, None, None)]
    rows += [(90, base[6] + " x", "en", "s0")] * 3 + [(91, "!! ".join(["LOUD"] * 300), "en", "s1")]
    rows += [(92, " ".join(f"{w}### $$$" for w in base[7].split()), "en", "s1"), (93, "same line here\n" * 50, "en", "s0")]
    rows += [(94, prose(rng, 20_000), "en", "s2"), (95, "Released under the MIT License. " + prose(rng, 30), "en", "s2")]
    return rows


def frame(spark, rows, clashes=True):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in CLASHES})
    return df.repartition(3)


def base_features(text):
    w, places = words(text), defaultdict(list)
    for i in range(len(w) - 7):
        places[tuple(w[i : i + 8])].append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines, seen, again = [x for x in (text or "").split("\n") if words(x)], set(), 0
    for line in lines:
        again += line in seen
        seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


def shingle_counts(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def near_classes(texts):
    """For each text the index of the first text of its class (similar pairs joined)."""
    counts, root = [shingle_counts(t) for t in texts], list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(counts):
        for j in range(i):
            b = counts[j]
            both, either = sum((a & b).values()), sum((a | b).values())
            if both and 5 * both >= 4 * either and top(i) != top(j):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(texts))]


def without_repeats(rows, length=50):
    """(bytes, removed, spans, what is left) of each (id, text) in order."""
    last = float("inf")
    first = {}
    for d, t in rows:
        b, key = (t or "").encode(), last if d is None else d
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            first[s] = min(first.get(s, last), key)
    out = []
    for d, t in rows:
        b, key = (t or "").encode(), last if d is None else d
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < key:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def shared_targets(sizes, weights, share, most):
    """Targets by sharing and resharing the excess until none is above its cap."""
    target = {s: 0.0 for s in sizes}
    left, open_ = share * sum(sizes.values()), dict(weights)
    while left > 1e-9 and open_:
        total = sum(open_.values())
        given = {s: left * w / total for s, w in open_.items()}
        left = 0.0
        for s, x in given.items():
            target[s] += x
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.pop(s)
    return target
