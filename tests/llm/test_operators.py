"""Operators against plain versions, on hard rows and on small tables."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import FOLDER
from tests.llm import brute
from tests.llm.brute import HARD, frame
from tokenloom.llm import chat, components, exact_dedup, licenses, mixing, packing, quality, queries, simhash, suffix_dedup, token_files, url_filter
from tokenloom.llm.common import Scratch
from tokenloom.llm.tokens import WordTokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.word_tokenizer_file())


@pytest.fixture(scope="module")
def documents():
    return duckdb.connect().sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()


def bag(rows):
    return Counter(map(tuple, rows))


def test_cached_ids_equal_those_of_whole_texts(tokenizer, documents):
    texts = [t or "" for _, t, *_ in [*HARD, *documents]]
    tool = WordTokenizer(queries.word_tokenizer_file(), limit=500)
    found = [ids[e - s : e].tolist() for n, ids, sizes in tool.encode_all(iter(texts), chars=9000) for s, e in zip(sizes, np.cumsum(sizes), strict=True)]
    assert found == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_cached_ids_of_random_texts(tokenizer):
    """Letters of many scripts, capitals that lower-case to several characters, marks, signs and digits, mixed at random."""
    draw = random.Random(11)
    some = list("aZéÉßẞİıŞΑΣςÅK\u212b\u0345\u0301\u0307Ǆǅǆᾈﬁ漢字가각ก\u0e33अ\u093f\u0915א\u05b0ب٣४१Ⅷⅷ𝐀𐐀🅰️ʰªº\u00ad\u200d_-'’s,..,!?12 \n\t\x1c\x85\u00a0\u2028")
    texts = ["İ.", "İ,", "aİ. İİ, x", "\u212b, K. ẞ. ß."] + ["".join(draw.choices(some, k=draw.randint(1, 12))) + draw.choice([".", ",", "", " "]) for _ in range(20_000)]
    tool = WordTokenizer(queries.word_tokenizer_file(), limit=5000)
    found = [ids[e - s : e].tolist() for n, ids, sizes in tool.encode_all(iter(texts), chars=9000) for s, e in zip(sizes, np.cumsum(sizes), strict=True)]
    wrong = [(t, f, e.ids) for t, f, e in zip(texts, found, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True) if f != e.ids]
    assert not wrong, wrong[:3]


def test_words_and_ascii_pieces_do_not_need_the_whole_tokenizer(tokenizer):
    """Words of Latin-1 letters and the parts of ASCII pieces are encoded by the model alone, with the ids of whole texts."""
    letters = [chr(c) for c in range(256) if chr(c).isalpha()]
    words = ["".join(w) for w in zip(letters, letters[7:], letters[23:], strict=False)] + ["canción", "straße", "µª", "ñandú"]
    texts = [" ".join(words), "a.b@c9.example.com it's they'll 'S ab### $$$ab |x| 555-7713 (017) <|x|> a<|endoftext|>b \x1f-x \x7f1 \"q\"", "\x1c'tis--12'd" * 3]
    tool, sent = WordTokenizer(queries.word_tokenizer_file()), []

    class Whole:
        model = tool.tokenizer.model

        def encode_batch_fast(self, pieces, add_special_tokens):
            sent.extend(pieces)
            return tokenizer.encode_batch_fast(pieces, add_special_tokens=add_special_tokens)

    tool.tokenizer = Whole()
    found = [ids.tolist() for text in texts for _, ids, _ in tool.encode_all(iter([text]))]
    assert found == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    # special tokens, control characters, runs of one kind and endings like 'll are left
    assert not [p for p in sent if p.isalpha() or (p.isascii() and p.isprintable() and "<|" not in p and p[0] != "'" and len({c.isalnum() for c in p}) > 1)]


def test_other_kinds_of_tokenizers_are_refused(tmp_path):
    path = tmp_path / "other.json"
    path.write_text('{"normalizer": null, "pre_tokenizer": {"type": "ByteLevel"}, "model": {}}')
    with pytest.raises(ValueError, match="not a lower-casing"):
        WordTokenizer(str(path))


@pytest.mark.parametrize("rows", [HARD, []])
def test_token_files_hold_all_documents_in_order(spark, tmp_path, tokenizer, rows):
    path = str(tmp_path / "t")
    token_files.write_token_files(frame(spark, rows), path, queries.word_tokenizer_file(), 1, block_ids=5000)
    found = token_files.digest_token_files(spark, path).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    ids = {(r[0], zlib.crc32(np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4").tobytes())) for r in rows}
    assert {(r["doc_id"], r["ids_crc32"]) for r in found} == ids
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in sorted(found, key=lambda r: r["start"])]
    assert order == sorted(order)
    back = token_files.read_token_files(spark, path).collect()
    assert {(r["doc_id"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in back} == ids


@pytest.mark.parametrize("rows", ["hard", "documents", []])
def test_near_groups_equal_all_pairs(spark, documents, rows):
    rows = HARD if rows == "hard" else documents if rows else []
    found = simhash.near_groups(frame(spark, rows), Scratch(spark, "t")).select("doc_id", "fp", "component_id").collect()
    prints, least = brute.near_components([r[:2] for r in rows])
    assert bag((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in found) == bag(zip((r[0] for r in rows), prints, least, strict=True))


@pytest.mark.parametrize("spread", [6, 14])
def test_near_links_of_dense_clusters(spark, spread):
    """Many fingerprints within few bits of each other, so values have many members and block values meet."""
    random, prints = np.random.default_rng(spread), set()
    for centre in random.integers(0, 2**63, 4, dtype=np.uint64).tolist():
        for _ in range(150):
            flips = random.choice(np.arange(0, 64, 64 // spread), random.integers(0, 6), replace=False)
            prints.add(centre ^ sum(1 << int(f) for f in flips))
    prints = sorted(prints)
    links = simhash.near_links(spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp long"), len(prints)).collect()
    pairs = {(a % 2**64, b % 2**64) for a, b in links}
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    both = pairs | {(b, a) for a, b in pairs}
    assert brute.components(prints, lambda a, b: (a, b) in both) == brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 3)


def test_large_buckets_look_up_block_values():
    random = np.random.default_rng(3)
    outs = random.choice(1 << 16, 900, replace=False).astype(np.uint64)
    bit = random.integers(0, 3, 900).astype(np.uint8)
    fp = (outs << np.uint64(48)) | np.where(bit > 0, np.uint64(1) << bit.astype(np.uint64), np.uint64(0))
    a, b = simhash._bucket_links(fp, bit, 3)
    linked = {*zip(a.tolist(), b.tolist(), strict=True)} | {*zip(b.tolist(), a.tolist(), strict=True)}
    nodes = sorted(set(fp.tolist()))
    assert all((x ^ y).bit_count() <= 3 for x, y in linked)

    def here(x, y):  # two that changed the same bit and differ in two or three bits of the block meet in another bucket
        apart, low = (x >> 48 ^ y >> 48).bit_count(), (1 << 48) - 1
        return (x ^ y).bit_count() <= 3 and (apart <= 1 or not (x & low and x & low == y & low))

    assert brute.components(nodes, lambda x, y: (x, y) in linked) == brute.components(nodes, here)


@pytest.mark.parametrize("rows", ["hard", "documents", []])
@pytest.mark.parametrize("part_bytes", [40_000, 1 << 24])
def test_repeats_equal_a_scan_of_all_strings(spark, monkeypatch, documents, rows, part_bytes):
    rows = HARD if rows == "hard" else documents if rows else []
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", part_bytes)
    found = suffix_dedup.remove_repeats(frame(spark, rows), with_text=True).collect()
    assert bag(r[:5] for r in found) == bag(brute.removed_repeats([r[:2] for r in rows]))
    assert all(hashlib.sha256(r["kept_text"]).hexdigest() == r["kept_sha256"] for r in found)


@pytest.mark.parametrize("shift", [-2000, -40, -17, -1, 0, 30])
def test_repeats_in_documents_beyond_a_mebibyte(spark, shift):
    """Passages of barely over the span with a period, around a byte where places of 20 bits begin anew."""
    draw = random.Random(shift)
    letters = lambda n: "".join(draw.choices("abcdefghijklmnop", k=n))
    unit, tail = letters(17), letters(3_000)
    passage = (unit * 4)[:52]
    rows = [(1, letters(500) + passage + letters(500), "en", "s", 1), (2, letters((1 << 20) + shift) + passage + tail, "en", "s", 1), (3, letters(700), "en", "s", 1)]
    found = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert found == {1: (0, 0), 2: (52, 1), 3: (0, 0)}


@pytest.mark.parametrize("size", [10, 4095, 4096, 9000])
def test_least_places_are_the_leftmost(monkeypatch, size):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 1000)
    gram = np.random.default_rng(size).integers(0, 5, size).astype(np.uint64)
    order = suffix_dedup.mixed(gram) >> np.uint64(20)
    want = [k + int(np.argmin(order[k : k + 35])) for k in range(size - 34)]
    assert suffix_dedup.least_places(gram).tolist() == want


@pytest.mark.parametrize("edges", [[], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)] + [(50, 51), (51, 50), (7, 7), (None, 3)]])
def test_components(spark, edges):
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5), Scratch(spark, "t"))
    nodes = sorted({n for e in edges if None not in e and e[0] != e[1] for n in e})
    both = {*edges, *((b, a) for a, b in edges)}
    assert dict(found.collect()) == brute.components(nodes, lambda a, b: (a, b) in both)
    assert found.count() == len(nodes)


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 7), "en", None if i % 11 == 0 else f"s{i % 5}", 1) for i in range(300)] + [(900, "big " * 4000, "en", "s1", 1), *HARD]
    plan = mixing.plan_mix(frame(spark, rows), (5, 2, 1), 3, queries.SCHEDULES, Scratch(spark, "t")).collect()
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(brute.WORD.findall(text or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in sizes if s not in full)
        over = {s for s in sizes if s not in full and weight[s] * rest > 3 * sizes[s] * open_weight}
        if not over:
            break
        full |= over
    taken = Counter()
    for r in plan:
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[r["source"]]
        want = 3 * sizes[r["source"]] if r["source"] in full else weight[r["source"]] * rest / open_weight
        assert abs(r["target"] - want) < 1e-6
        assert sum(p["words"] for p in r["passes"]) == r["taken"]
        assert all(0 <= p["position"] <= 1 for p in r["passes"])
    assert len(plan) == len(rows)
    longest = {s: max(r["size"] for r in plan if r["source"] == s) for s in sizes}
    # a source gives at least one document, however small its target
    alone = {s for s in sizes if len([r for r in plan if r["source"] == s and r["taken"]]) == 1}
    assert all(2 * abs(taken[s] - t) <= longest[s] + 1 or s in alone and taken[s] > t for s, t in {(r["source"], r["target"]) for r in plan})
    assert mixing.plan_mix(frame(spark, []), (5, 2, 1), 3, queries.SCHEDULES, Scratch(spark, "t")).count() == 0


def test_positions_invert_the_schedule(spark):
    knots = ((0.0, 0.0), (0.3, 2.0), (0.5, 0.0), (0.7, 0.0), (1.0, 1.0))
    area = lambda t: sum((min(t, b) - a) * (h + h + (k - h) * (min(t, b) - a) / (b - a)) / 2 for (a, h), (b, k) in zip(knots, knots[1:], strict=False) if t > a)
    shares = [k / 200 for k in range(200)]
    found = spark.createDataFrame([(s,) for s in shares], "s double").select(mixing.training_position(F.col("s"), knots)).collect()
    times = [r[0] for r in found]
    assert times == sorted(times)
    assert all(abs(area(t) / area(1.0) - s) < 1e-9 for t, s in zip(times, shares, strict=True))


def test_mixed_documents_hold_the_words_of_the_plan(spark):
    docs = frame(spark, HARD)
    plan = mixing.plan_mix(docs, (5, 2, 1), 3, queries.SCHEDULES, Scratch(spark, "t"))
    found = mixing.mixed_documents(docs, plan)
    assert found.columns == docs.columns
    words = Counter()
    texts = {(r[0], r[1]) for r in HARD}
    for r in found.collect():
        words[r["source"]] += len(brute.WORD.findall(r["text"]))
        assert (r["doc_id"], r["text"]) in texts
    want = Counter()
    for r in plan.collect():
        want[r["source"]] += r["taken"]
    assert words == want


def test_cuckoo_filter_inserts_finds_deletes_and_grows():
    random = np.random.default_rng(1)
    keys = random.integers(0, 2**63, 5000, dtype=np.uint64)
    small = exact_dedup.CuckooFilter(64)
    assert not small.insert(keys)
    made = exact_dedup.CuckooFilter.of(keys)
    assert made.contains(keys).all()
    other = random.integers(0, 2**63, 20_000, dtype=np.uint64)
    assert made.contains(other).mean() < 0.01
    made.delete(keys[:2500])
    assert made.contains(keys[2500:]).all() and made.contains(keys[:2500]).mean() < 0.01
    again = exact_dedup.CuckooFilter.of(np.repeat(keys[:4], 2))
    again.delete(keys[:4])
    assert again.contains(keys[:4]).all()  # each key went in twice


def exact(rows):
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r"), []).append((-len(t or ""), d is None, d or 0, d))
    out = []
    for d, t, *_ in rows:
        h = "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
        keep = min(groups[h])[3]
        out.append((d, keep, len(groups[h]), d == keep, hashlib.sha256(h.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("rows", ["hard", "documents", []])
def test_exact_groups(spark, documents, rows):
    rows = HARD if rows == "hard" else documents if rows else []
    found = exact_dedup.exact_groups(frame(spark, rows), Scratch(spark, "t")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert bag(found.collect()) == bag(exact(rows))


def test_index_takes_additions_and_removals(spark):
    scratch, live = Scratch(spark, "t"), lambda rows: exact_dedup.digests(frame(spark, rows))
    index = scratch.keep(exact_dedup.build_index(live(HARD[:8]), 3), "a")
    index = scratch.keep(exact_dedup.update_index(index, 3, added=live(HARD[8:])), "b")
    read = lambda i: bag((bytes(r[0]).hex(), r[1]) for r in exact_dedup.index_groups(i).collect())
    assert read(index) == bag({(h, n) for _, _, n, _, h in exact(HARD)})
    index = scratch.keep(exact_dedup.update_index(index, 3, removed=live(HARD[:8])), "c")
    assert read(index) == bag({(h, n) for _, _, n, _, h in exact(HARD[8:])})
    assert exact_dedup.index_groups(exact_dedup.update_index(index, 3, removed=live(HARD[8:]))).count() == 0


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>user\n<\\| <\\\\|im_end|> <| <"), (1, 2, "user", None), (1, 3, "assistant", ""),
    (2, 0, "assistant", "first"), (2, 1, "us\ner%0A<|", "odd role"), (3, None, None, None), (3, 0, "user", "x"), (3, 0, "user", "x"),
    (None, 0, "user", "no id"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "a" * 100_000), (4, 3, "tool", "t"), (4, 4, "assistant", "é\U0001f600"),
]


def test_conversations_read_back(spark):
    turns = spark.createDataFrame([(*t, "x", 1) for t in TURNS], "conv_id long, turn long, role string, text string, segment string, loss int")
    found = {r["conv_id"]: r for r in chat.read_back(chat.write_segments(turns, Scratch(spark, "t"))).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    for conv, r in found.items():
        mine = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        learned = "".join(t[3] or "" for t in mine if t[2] == "assistant")
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in mine).encode()).hexdigest()
        assert (r["n_turns"], r["loss_chars"]) == (len(mine), len(learned))
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    assert [found[c]["first_error"] for c in (1, 2, 3, 4)] == [None, 0, 0, None]
    assert found[4]["complete"] and not found[3]["complete"]
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_licences_equal_the_plain_cosine(spark, documents):
    rows = [(i, r[1]) for i, r in enumerate([*HARD, *documents])] + [(9999, "x y\nreleased under an MIT license\nLicensed under CC BY 4.0")]
    files = spark.createDataFrame([(k, t, "x") for k, t in rows], "file long, text string, terms string").repartition(3)
    found = licenses.scan_licences(files.withColumn("path", F.lit(None).cast("string")), Scratch(spark, "t")).collect()
    want = brute.licences(rows, licenses.TEMPLATES, licenses.STOP_WORDS, licenses.THRESHOLD)
    assert len(found) == len(rows) and len(want) > 3
    assert {r["file"]: (r["license"], round(r["similarity"], 5)) for r in found if r["license"]} == {k: (n, round(s, 5)) for k, (n, s) in want.items()}


def test_licences_of_null_and_repeated_ids(spark, tmp_path):
    rows = [*HARD, (None, "Released under the MIT License.", "en", "a", 1), (3, "Licensed under CC BY 4.0.", "en", "b", 1), (3, "plain words only here", "en", "c", 1), (None, "none", "fr", "d", 1)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op7_licenses(spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    got = {(r["doc_id"], r["path"]): r["license"] for r in found}
    assert [got[k] for k in ((None, "a/en"), (3, "b/en/3"), (3, "c/en/3"), (None, "d/fr"))] == ["MIT", "CC-BY-4.0", None, None]


def test_licences_are_inherited_from_the_nearest_directory(spark):
    files = [
        (1, "a/LICENSE", "Released under the MIT License.\nsome words"), (2, "a/b/c/x.py", "code"), (3, "a/b/COPYING.txt", "Licensed under CC BY 4.0."),
        (4, "a/d/x.py", "code"), (5, "e/x.py", "code"), (6, "a/b/c/y.py", "Licensed under the Apache License, Version 2.0."), (7, None, "code"), (8, "x", None),
        (9, "f/any.txt", "\nReleased under the MIT License.\n"), (10, "f/z", ""),
    ]
    found = licenses.scan_licences(spark.createDataFrame(files, "file long, path string, text string"), Scratch(spark, "t")).collect()
    got = {r["file"]: (r["license"], r["origin"]) for r in found}
    assert got == {
        1: ("MIT", "own"), 2: ("Apache-2.0", "inherited"), 3: ("CC-BY-4.0", "own"), 4: ("MIT", "inherited"), 5: (None, None),
        6: ("Apache-2.0", "own"), 7: (None, None), 8: (None, None), 9: ("MIT", "own"), 10: ("MIT", "inherited"),
    }
    assert licenses.scan_licences(spark.createDataFrame([], "file long, path string, text string"), Scratch(spark, "t")).count() == 0


def test_quality_on_hard_rows_and_ablation(spark):
    docs = frame(spark, HARD).drop("bits", "kept", "n_words")
    marked = quality.apply_policy(quality.ledger(docs))
    rows = marked.collect()
    for r in rows:
        tokens = brute.WORD.findall(r["text"] or "")
        windows = Counter(tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4))
        repeated = {i + k for i in range(len(tokens) - 4) if windows[tuple(tokens[i : i + 5])] > 1 for k in range(5)}
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(tokens), sum(map(len, tokens)), len(repeated))
    mask = quality.mask_of(quality.POLICIES["v2"])
    assert sum(r["kept"] for r in rows) == sum(r["bits"] & mask == 0 for r in rows)
    for r in quality.ablation(marked).collect():
        bit = quality.mask_of((r["rule"],))
        assert r["failed"] == sum(bool(x["bits"] & bit) for x in rows)
        assert r["rejected_alone"] == sum(x["bits"] & mask == bit for x in rows)


def test_block_decisions_reach_aliases(spark):
    link = lambda href: f'<link href="{href}" rel="canonical">'
    pages = [
        (1, "http://Bad.org/x", "", None), (2, "http://a.com/1", '<link rel="canonical" href="http://bad.org/x">', 1), (3, "http://b.com/2", link("http://a.com/1"), 1),
        (4, "https://good.org/y?q", "", 1), (5, "http://c.com/3", '<META http-equiv=refresh content="0; url=https://good.org/y?q">', 1),
        (6, "http://bad.org/z", link("https://good.org/y?q"), 1), (7, None, "", 1), (8, "no-scheme/x", link("http://bad.org/x"), 1), (9, "http://d.com", None, 1), (1, "http://Bad.org/x", "", None),
    ]
    rules = [("bad.org", "/", "block"), ("good.org", "/y", "allow")]
    found = url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string, rule int"), rules, Scratch(spark, "t")).collect()
    got = sorted((r["page_id"], r["verdict"], r["decided_by"]) for r in found)
    assert got == [
        (1, "block", "rule"), (1, "block", "rule"), (2, "block", "alias"), (3, "block", "alias"), (4, "allow", "rule"), (5, "allow", "alias"),
        (6, "block", "rule"), (7, "allow", "default"), (8, "block", "alias"), (9, "allow", "default"),
    ]
    assert {(r["host"], r["path"]) for r in found if r["page_id"] in (1, 8, 9)} == {("bad.org", "/x"), ("", ""), ("d.com", "")}


LINKED = [
    ("http://x.org/en/a", "/bad/p", "http://x.org/bad/p"), ("http://x.org/en/a?q=1", "b", "http://x.org/en/b"), ("http://x.org", "b", "http://x.org/b"),
    ("https://x.org/en/", "//y.org/z", "https://y.org/z"), ("http://x.org/a/b/c", "../d?x=/../e", "http://x.org/a/d?x=/../e"), ("http://x.org/a/b", "../../../d", "http://x.org/d"),
    ("http://x.org/a/b", "./", "http://x.org/a/"), ("http://x.org/a/b?c#d", "?e", "http://x.org/a/b?e"), ("http://x.org/a", "#top", None), ("http://x.org/a", "mailto:x@y", None),
    ("http://x.org/a", "http://y.org/?a=1&amp;b=2", "http://y.org/?a=1&b=2"), ("no-scheme/x", "/y", None), ("no-scheme/x", "http://y.org/", "http://y.org/"), ("http://x.org/a", "c:d", None),
    ("http://x.org/a?u=http://z.org/b", "c", "http://x.org/c"), ("http://x.org/a/b", "..", "http://x.org/"),
]


def test_link_targets_are_resolved(spark):
    found = spark.createDataFrame([(k, u, t) for k, (u, t, _) in enumerate(LINKED)], "k int, url string, target string")
    found = found.select("k", url_filter.resolved(F.col("target"), F.col("url")).alias("other")).collect()
    assert {r["k"]: r["other"] for r in found} == {k: want for k, (_, _, want) in enumerate(LINKED)}


def test_relative_links_carry_decisions(spark):
    pages = [
        (1, "http://x.org/en/a", '<link rel=canonical href="/bad/p">'), (2, "http://x.org/en/b", '<meta content="0; url=../bad/q" http-equiv="refresh">'),
        (3, "http://y.org/c", '<link href="//x.org/bad/r?a=1&amp;b=2" rel="canonical">'), (4, "http://x.org/en/d", '<a href="/bad/p">'), (5, "http://z.org/e", '<link rel="canonical" href="http://x.org/en/a">'),
    ]
    found = url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), [("x.org", "/bad/", "block")], Scratch(spark, "t")).collect()
    assert {r["page_id"]: (r["verdict"], r["decided_by"]) for r in found} == {
        1: ("block", "alias"), 2: ("block", "alias"), 3: ("block", "alias"), 4: ("allow", "default"), 5: ("block", "alias")
    }


@pytest.mark.parametrize("length", [32, 4096])
def test_packing_loses_nothing_and_pads_little(spark, tokenizer, documents, length):
    rows = [*HARD, *documents]
    found = packing.pieces(packing.pack(frame(spark, rows), queries.word_tokenizer_file(), 2, length=length)).collect()
    by_sequence, by_doc = {}, {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    padded = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == parts[0]["n_ids"] <= length
        assert parts[0]["padded_to"] == (at if at & (at - 1) == 0 else length)
        padded += parts[0]["padded_to"] - at
    ids = [[*e.ids, 2] for e in tokenizer.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]
    assert padded <= 0.02 * sum(map(len, ids)) or length < 4096
    unique = {(r[0], len(i)): i for r, i in zip(rows, ids, strict=True)}
    assert Counter(k for k, v in by_doc.items() for r in v if r["start"] == 0) == Counter((r[0], len(i)) for r, i in zip(rows, ids, strict=True))
    for key, parts in by_doc.items():
        for r in parts:
            same = unique[key][r["start"] : r["start"] + r["length"]]
            assert len(same) == r["length"]
            if key[0] is not None and key[0] != 3:
                assert zlib.crc32(np.array(same, "<u4").tobytes()) == r["ids_crc32"]
    assert sum(r["length"] for r in found) == sum(map(len, ids))


def test_cuts_are_the_cheapest(spark):
    random = np.random.default_rng(7)
    for _ in range(30):
        ends = np.cumsum(random.integers(1, 5, 40))
        costs = random.integers(0, 6, 40).astype(float)
        cuts = packing.best_cuts(ends, costs, 16)
        price = dict(zip(ends.tolist(), costs.tolist(), strict=True))
        total = lambda cs: sum(16 - (b - a) + price[b] for a, b in zip([0, *cs[:-1]], cs, strict=True))
        best = {0: 0.0}
        for e in ends.tolist():
            best[e] = min(best[s] + 16 - (e - s) + price[e] for s in best if e - s <= 16)
        assert cuts[-1] == ends[-1] and all(b - a <= 16 for a, b in zip([0, *cuts[:-1]], cuts, strict=True))
        assert total(cuts) == best[int(ends[-1])]


def test_cuts_of_long_streams_follow_sentences_and_documents():
    """Rounds leave the windows room, so cuts lie at ends of sentences and documents and cost less than cuts at every 4096 ids."""
    random, length, mark = np.random.default_rng(3), 4096, 7
    docs = [np.append(random.choice([mark, *range(10, 40)], n), 2).astype(np.uint32) for n in random.integers(300, 1500, 900)]
    packer = packing._Packer(0, length, np.array([mark], np.uint32), 8, 64)
    found = [row for k, ids in enumerate(docs) for row in packer.add(k, ids)] + list(packer.finish())
    stream, closed = np.concatenate(docs), {int(n) for n in np.cumsum([len(d) for d in docs])}
    assert b"".join(row[3] for row in found) == stream.astype("<u4").tobytes() and len(stream) > 2 * packing.ROUND
    price = lambda cut: 0 if cut in closed else 8 if stream[cut - 1] == mark else 64
    cuts = np.cumsum([row[1] for row in found]).tolist()
    long = [(cut, row) for cut, row in zip(cuts, found, strict=True) if row[2] == length]
    assert len(long) > len(stream) // length - 2 and sum(price(cut) <= 8 for cut, _ in long) >= 0.9 * len(long)
    spent = sum(price(cut) for cut in cuts) + sum(row[2] - row[1] for row in found)
    assert spent < 0.6 * sum(price(cut) for cut in range(length, len(stream), length))


@pytest.mark.parametrize("n", [1, 31, 32, 33, 64, 100, 511, 512, 513, 1000, 4000])
def test_streams_of_any_length_end_in_powers_of_two(n):
    random = np.random.default_rng(n)
    ids = random.choice([7, 8, 9, 10, 11], n).astype(np.uint32)
    packer = packing._Packer(0, 32, np.array([7], np.uint32), 1, 4)
    found = [*packer.add(1, ids), *packer.finish()]
    assert b"".join(row[3] for row in found) == ids.astype("<u4").tobytes()
    assert all(0 < row[1] <= 32 and row[2] == (row[1] if row[1] & (row[1] - 1) == 0 else 32) for row in found)
    assert found[-1][2] == found[-1][1] or found[-1][1] > 16
    assert [row[0] for row in found] == list(range(len(found)))
