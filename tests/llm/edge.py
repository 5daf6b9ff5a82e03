"""Small tables with every awkward row, and plain versions of the operators."""

import collections
import hashlib
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, h string, score double, w string, class string"

BASE = " ".join(f"word{i % 37}x{i}" for i in range(120))
NEAR = BASE.replace("word5x5 ", "other ").replace("word9x9 ", "another ")
LONG = " ".join(f"long{i}" for i in range(30_000))


def _row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None, 7, "h", 0.1, "w", "c")


ROWS = [
    _row(1, BASE),
    _row(2, BASE, source="b"),
    _row(3, NEAR, source="b"),
    _row(3, NEAR, source="b"),
    _row(4, None),
    _row(5, ""),
    _row(6, " \t\n\x0b\x0c\r "),
    _row(None, "a null id holds four words and more " + BASE[:200], None, None),
    _row(None, None, None, None),
    _row(7, "three short words", "de"),
    _row(8, "THREE short words", "de"),
    _row(9, "a a a a a a a a a a " * 12, "de", None),
    _row(10, LONG, "fr", "c"),
    _row(11, "12 34 !!! ###"),
    _row(12, "the same line\nthe same line\r\nthe same line\n\n... \n- item"),
    _row(13, "café naïve ÉTÉ \U0001f600   nbsp", "fr", "c"),
]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def components(rows, percent=75):
    """(doc_id, set size, least id reachable) of each row; all pairs tested."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)].append(doc_id)
    return sorted(
        (str(d), len(s), str(min(low[find(i)], default=None) if s else d))
        for i, ((d, _), s) in enumerate(zip(rows, sets))
    )


def without_repeats(rows, width=35):
    """(doc_id, words, removed, digest of the rest) of each row."""
    held = [words(t) for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + width]) for w in held for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, held):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        rest = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(doc_id), len(w), len(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return sorted(out)
