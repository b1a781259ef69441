"""Plain-Python versions of the operators for small fixtures."""

import hashlib
import re
from collections import Counter

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
P60 = " ".join(f"w{i}" for i in range(60))
V35 = " ".join(f"v{i}" for i in range(35))

#: Null, empty, blank, tied, repeated, near and long texts; null and repeated ids.
DOCS = [(1, "a b c"), (2, "A b  c"), (3, None), (4, ""), (5, " \t\n"), (6, "a a a a a a a"), (7, "a a a a a"),
        (None, "q w e r t y"), (8, "q w e r t y"), (9, "q w e r t y u"), (10, "one"), (10, "one"), (10, "two"),
        (11, P60), (12, "x y " + P60 + " z"), (13, P60.replace("w30", "other")), (14, P60), (15, "x" * 3000),
        (16, "é😀 ü " * 40), (17, "q " + V35), (18, V35 + " z"), (19, " ".join(f"v{i}" for i in range(34))),
        (20, "no " * 200), (21, P60 + " " + P60)]


def frame(spark, rows=DOCS, extra=True):
    """Documents with columns whose names clash with those the operators use inside."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        for name in ("_row", "_text", "key", "n", "size", "shard", "spans", "ids", "c1", "kind"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def split_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def jaccard_components(rows):
    sets = []
    for _, text in rows:
        w = split_words((text or "").translate(UPPER))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted((str(i), len(sets[k]), str(least.get(root(k), i))) for k, (i, _) in enumerate(rows))


def without_repeats(rows, window=35):
    lists = [split_words(t) for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(rows, lists):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(key), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    twice = [x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, digits[::-1]))]
    return sum(twice) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                    "card": lambda: 13 <= len(digits) <= 19 and _luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}
            if fine[kind]():
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)
