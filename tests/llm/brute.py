"""Plain versions of the operators over a few rows, and rows that are hard to handle."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
#: (doc_id, text, lang, source, n_chars): nulls in every column, empty and long texts, ties, repeated rows.
HARD = [
    (1, "The quick brown fox jumps over the lazy dog, again and again until night falls.", "en", "src0", 80),
    (2, "The quick brown fox jumps over the lazy dog, again and again until night falls.", "en", "src1", 80),
    (3, " The quick\tbrown fox jumps over the lazy dog,\nagain and again until night falls. ", "en", "src1", 83),
    (3, " The quick\tbrown fox jumps over the lazy dog,\nagain and again until night falls. ", "en", "src1", 83),
    (3, "Another text of the same id that shares nothing with the rest, Ünïcödé 漢字 \U0001f600 included.", "de", None, None),
    (4, None, None, None, None),
    (5, "", "en", "", 0),
    (6, " \t\n\r\x0b\x0c", "en", "src0", 6),
    (None, "The quick brown fox jumps over the lazy dog, again and again until night falls.", "en", "src2", 80),
    (None, None, None, None, None),
    (7, LONG, "en", "src2", len(LONG)),
    (8, LONG + " tail", "en", "src0", len(LONG) + 5),
    (9, "a" * 3000, "en", "src3", 3000),
    (10, "one two", "en", "src3", 7),
    (11, "É È İ ΑΣ <|endoftext|> <|EndOfText|> don't it's 1234 x.y,z. ... a b\x1cc", "fr", "src0", 50),
    (12, "\n".join(["Released under the MIT License."] * 3), "en", "src1", 90),
]
CLASHING = ("bucket", "part", "fp", "digest", "kept", "bits", "n_words", "doc", "passes", "size", "component", "text_hash")


def frame(spark, rows, kinds=("long", "string", "string", "string", "long")):
    """The rows as documents, with further columns whose names operators use inside."""
    names = ("doc_id", "text", "lang", "source", "n_chars")
    of = {"long": T.LongType(), "string": T.StringType()}
    schema = T.StructType([T.StructField(n, of[k]) for n, k in zip(names, kinds, strict=True)] + [T.StructField(c, T.StringType()) for c in CLASHING])
    return spark.createDataFrame([(*r, *("x" for _ in CLASHING)) for r in rows], schema).repartition(3)


def fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    tokens = WORD.findall(lowered)
    grams = [" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)] if len(tokens) >= 3 else [" ".join(tokens)] if tokens else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(nodes, linked):
    """Smallest member of each node's component, by trying all pairs; None counts as largest."""
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                ra, rb = sorted((root(a), root(b)))
                label[rb] = ra
    return {n: root(n) for n in nodes}


def near_components(rows):
    """component_id of each row of (doc_id, text)."""
    prints = [fingerprint(t) for _, t in rows]
    roots = components(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (d, _), p in zip(rows, prints, strict=True):
        r = roots[p]
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return prints, [least[roots[p]] for p in prints]


def removed_repeats(rows, span=50):
    first, out = {}, []
    data = [(d, (t or "").encode()) for d, t in rows]
    for d, b in data:
        for i in range(len(b) - span + 1):
            if d is not None:
                h = b[i : i + span]
                first[h] = min(first.get(h, d), d)
    for d, b in data:
        mark = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if d is not None and first[b[i : i + span]] < d:
                mark[i : i + span] = b"\1" * span
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        spans = mark.count(b"\0\1") + (mark[:1] == b"\1")
        out.append((d, len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return out


def licence_terms(text, stop):
    return [t for t in re.split(r"[\W_]+", text.lower()) if t and t not in stop]


def licences(rows, templates, stop, threshold):
    """(license, similarity) of each row's best line, for rows (key, text)."""
    vocabulary = {t for _, x in templates for t in licence_terms(x, stop)}
    lines = [(k, n, licence_terms(line, stop)) for k, t in rows if t is not None for n, line in enumerate(t.split("\n"))]
    total = sum(len((t or "").split("\n")) for _, t in rows)
    df = Counter(t for _, _, ts in lines for t in set(ts) & vocabulary)
    weigh = lambda n: math.log((total + 1) / (n + 1)) + 1
    vectors = {}
    for name, x in templates:
        tf = Counter(licence_terms(x, stop))
        v = {t: n * (weigh(df[t]) if t in df else 1.0) for t, n in tf.items()}
        length = math.sqrt(sum(w * w for w in v.values()))
        vectors[name] = {t: w / length for t, w in v.items()}
    best = defaultdict(list)
    for k, n, ts in lines:
        tf = Counter(ts)
        known = {t: c * weigh(df[t]) for t, c in tf.items() if t in vocabulary}
        if not known:
            continue
        others = sum(c for t, c in tf.items() if t not in vocabulary)
        norm = math.sqrt(sum(w * w for w in known.values()) + others * weigh(0) ** 2)
        for name, v in vectors.items():
            s = round(sum(w * v.get(t, 0.0) for t, w in known.items()) / norm, 6)
            if s >= threshold:
                best[k].append((-s, n, name))
    return {k: (min(found)[2], -min(found)[0]) for k, found in best.items()}
