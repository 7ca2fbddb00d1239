"""Documents with every odd case, and brute-force forms of the operators."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, line string, node bigint, score double, size int, value string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, ids=None, sources=None):
    """Documents with columns whose names operators could use themselves."""
    ids = range(len(texts)) if ids is None else ids
    sources = [f"src{i % 3}" for i in range(len(texts))] if sources is None else sources
    rows = [(i, t, None, s, None, "x", 1, 0.5, 3, None) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts():
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    return [None, "", " \t\n ", "a", "one two three", "Ünïcödé ñandú 日本語   x", "\n\n\n", long, "same text here again", "same text here again", "x" * 5000, "\x1c\x85 z"]


def random_texts(seed, n, vocabulary=40, words=60):
    """Texts with copies, near copies and shared lines."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdéß") for _ in range(rnd.randint(1, 6))) for _ in range(vocabulary)]
    texts = []
    for _ in range(n):
        if texts and rnd.random() < 0.5:
            w = rnd.choice(texts).split(" ")
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            texts.append(" ".join(w))
        else:
            texts.append(" ".join(rnd.choice(vocab) + rnd.choice(["", "", "", "\n", "."]) for _ in range(rnd.randint(1, words))))
    return texts


def words(text):
    return WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def shingles(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def near_components(texts, n):
    """Smallest index reachable over similar pairs, by looking at all pairs."""
    sets = [shingles(t, n) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * len(a | sets[j]):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def repeated_bytes(texts, length):
    """Per text: which bytes lie in a string of that length that starts elsewhere too."""
    raw = [(t or "").encode() for t in texts]
    count = {}
    for t in raw:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(gone)
    return out


def runs(marks):
    return sum(1 for i, m in enumerate(marks) if m and (i == 0 or not marks[i - 1]))
