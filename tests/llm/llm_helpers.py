"""Small tables and plain Python versions that the operators are held against."""

import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE_SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, hash int, uid string, "
               "`row` string, f int, n_words int, length string, `count` int, n_tokens string, secrets int, `a.b` int")


def edge_rows():
    """Nulls, empty and blank texts, repeated rows and ids, ties, a long text; and clashing further columns."""
    long_text = " ".join(f"word{i % 977}" for i in range(30_000)) + "\nlast line"
    texts = [
        (0, "The quick brown fox jumps over the lazy dog near the river bank while nine old men sing songs of home"),
        (1, "The quick brown fox jumps over the lazy dog near the river bank while nine old men sing songs of home"),
        (2, "The quick brown  fox jumps over the lazy dog near the river bank while nine old men sing songs of\nhome"),
        (2, "The quick brown  fox jumps over the lazy dog near the river bank while nine old men sing songs of\nhome"),
        (3, None), (4, ""), (5, " \t\n"), (None, "a text without an id"), (None, None),
        (6, long_text), (7, long_text + " "), (8, "x"), (9, "éü ßœ 日本 🙂🙂 \u00a0 end"), (9, "another text, same id"),
        (10, "one two three"), (11, "ONE Two three"), (12, "password = hunter2hunter2 and more"),
    ]
    return [(i, t, "en", None if n % 3 else "src0", None if t is None else len(t), n, "u", "r", n, 1, "l", 2, "t", 3, 4)
            for n, (i, t) in enumerate(texts)]


def edge_table(spark):
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA)


def empty_table(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


def small_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def fingerprint(text, n=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest node reachable from each, by trying all pairs."""
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ordered = sorted(nodes)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def statistics(text):
    """(words, their characters, symbols, repeated lines, words in repeated windows of eight)."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    repeated = {p for i, w in enumerate(windows) if times[w] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(repeated))


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
        if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]
