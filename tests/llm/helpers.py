"""Small corpora with copies, near copies and odd rows, and plain reference code."""

import random
import re


def words(rng, n):
    return [rng.choice("abcdefghijklmnop") + rng.choice("aeiou") + str(rng.randrange(60)) for _ in range(n)]


def corpus(seed=1, n=60):
    """Rows (doc_id, text): unique texts, exact and near copies, empty, null, short and odd ones."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        texts.append(" ".join(words(rng, rng.choice([1, 3, 4, 5, 8, 40, 120]))))
    for k in range(n):
        base = texts[rng.randrange(n)].split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            base[rng.randrange(len(base))] = "new" + str(rng.randrange(99))
        texts.append(rng.choice([" ", "\n", "\t "]).join(base).replace("a1", "A1"))
    texts += ["", None, "  \n ", "É é", "é é", "One two", "one two", " ".join(words(rng, 4000))]
    return list(enumerate(texts, 100))


def byte_words(text):
    return [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))) if w]


def shingle_set(text, width=5):
    w = byte_words(text)
    if not w:
        return set()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


class Union:
    """Components with the smallest member as their name."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
