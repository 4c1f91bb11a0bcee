"""Small inputs and brute-force versions for the tests of the llm subpackage."""

import re

from pyspark.sql import Row
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names that the operators use for columns of their own.
CLASHES = "row task rank length node component bucket text_md5 value spans segment place host n key id label part kind start end words items".split()


def docs_of(spark, texts, langs=None, sources=None, clashes=False):
    """Documents numbered from 0; a text may be a pair (doc_id, text)."""
    rows = []
    for i, text in enumerate(texts):
        doc_id, text = text if isinstance(text, tuple) else (i, text)
        rows.append(
            Row(doc_id, text, langs[i] if langs else "en", sources[i] if sources else "src0", None if text is None else len(text))
        )
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if clashes:
        for name in CLASHES:
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def groups(n, links):
    """The smallest number that links reach, for numbers below n."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(x) for x in range(n)]


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not found:
        return frozenset()
    if len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def near_groups(texts, words, percent):
    sets = [shingles(t, words) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return [len(s) for s in sets], groups(len(sets), links)


def contaminated(texts, items, window=10):
    """Per text: words, places of hit words, numbers of items."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    known = {}
    for k, item in enumerate(items):
        own = word.findall(lower(item))
        n = min(window, len(own))
        for i in range(len(own) - n + 1) if n else ():
            known.setdefault(tuple(own[i : i + n]), set()).add(k)
    out = []
    for text in texts:
        own, hit, found = word.findall(lower(text)), set(), set()
        for n in {len(k) for k in known}:
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) in known:
                    found |= known[tuple(own[i : i + n])]
                    hit.update(range(i, i + n))
        out.append((len(own), sorted(hit), found))
    return out


def repeated_spans(texts, length):
    """Removed runs of each text's bytes."""
    starts = {}
    data = [(t or "").encode() for t in texts]
    for t in data:
        for i in range(len(t) - length + 1):
            starts[t[i : i + length]] = starts.get(t[i : i + length], 0) + 1
    out = []
    for t in data:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans, at = [], 0
        while at < len(t):
            end = at
            while end < len(t) and gone[end]:
                end += 1
            if end > at:
                spans.append((at, end))
            at = max(end, at + 1)
        out.append(spans)
    return out


BASE = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
)


def base_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            if kind == "assign" and len(m[2]) >= 6 or kind == "access" and len(m[0]) >= 20 or kind == "hex" and len(m[0]) >= 24:
                found.append((m.start(), k, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]
