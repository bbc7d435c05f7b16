"""The definitions in plain Python, written for checking."""

import math
import re
import unicodedata
from collections import Counter

from docsim.functions.text import STOPWORDS


def prepare(text):
    text = unicodedata.normalize("NFD", (text or "").lower())
    text = "".join(c for c in text if unicodedata.category(c) != "Mn")
    text = re.sub(r"http\S+|www\S+", " ", text)
    words = re.sub(r"[^a-z0-9]+", " ", text).split()
    return " ".join(w for w in words if len(w) > 2 and w not in set(STOPWORDS))


def cosine(a, b):
    """TF-IDF cosine with the smooth idf fitted on the two texts, term by term."""
    a, b = Counter(a.split()), Counter(b.split())
    if not a or not b:
        return 0.0

    def weights(counts):
        w = {}
        for term, tf in counts.items():
            df = (term in a) + (term in b)
            w[term] = tf * (math.log((1 + 2) / (1 + df)) + 1)
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {term: x / norm for term, x in w.items()}

    wa, wb = weights(a), weights(b)
    return sum(x * wb.get(term, 0.0) for term, x in wa.items())
