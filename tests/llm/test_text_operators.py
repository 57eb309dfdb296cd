"""Duplicates, passages, statistics, pieces and packing against brute force."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from duewatch.llm import bins, minhash, packing, pieces, quality_rules, substrings, word_statistics

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def removed_by_force(texts, width):
    counts = collections.Counter(
        tuple(w[i : i + width]) for w in map(words, texts) for i in range(len(w) - width + 1)
    )
    for own in map(words, texts):
        gone = [False] * len(own)
        for i in range(len(own) - width + 1):
            if counts[tuple(own[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        yield own, gone


@pytest.mark.parametrize("width, block_bytes", [(35, 8 << 20), (4, 2000)])
def test_repeated_windows(odd_docs, width, block_bytes):
    source = odd_docs.collect()
    expected = []
    for row, (own, gone) in zip(source, removed_by_force([r.text for r in source], width)):
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        expected.append((row.doc_id, len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    found = substrings.without_repeats(odd_docs, width=width, block_bytes=block_bytes, range_windows=500)
    assert rows_of(found) == sorted(expected, key=repr)


def test_cut_documents_keep_their_columns(odd_docs, no_docs):
    cut = substrings.passages_cut(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()
    assert substrings.passages_cut(no_docs).count() == 0


def components_by_force(sets, percent):
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def shingles(text):
    own = [w.encode().lower() for w in words(text)]
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} or ({tuple(own)} if own else set())


def test_near_duplicates(odd_docs, no_docs):
    source = odd_docs.collect()
    sets = {r.doc_id: shingles(r.text) for r in source if r.doc_id is not None}
    components = components_by_force(sets, 75)
    expected = [
        (r.doc_id, len(shingles(r.text)), components.get(r.doc_id), r.doc_id is None or components[r.doc_id] == r.doc_id)
        for r in source
    ]
    found = minhash.near_duplicates(odd_docs)
    assert rows_of(found) == sorted(expected, key=repr)
    kept = minhash.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(e[3] for e in expected)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_links_across_components_of_a_band(spark):
    """A chain in which neighbours link and the least document links with few of the others."""
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[4 * i : 4 * i + 80])) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    components = components_by_force({i: shingles(t) for i, t in rows}, 75)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == components


def test_register_estimates_follow_the_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for shared in (0.5, 0.75, 0.9):
        size = int(2000 * (1 + shared) / 2)
        a, b = np.sort(pool[:size]), np.sort(pool[2000 - size : 2000])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        regs = minhash.sketches([a, b])
        assert abs(minhash.estimates(regs[:1], regs[1:])[0] - true) < 0.15


def test_statistics(odd_docs):
    for text in [r.text for r in odd_docs.collect()] + ["a | b | c", "l\nl\n\n\nl x\nl x\n", "a b c d e f g h " * 4]:
        own = words(text)
        windows = collections.Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
        under = set()
        for i in range(len(own) - 7):
            if windows[tuple(own[i : i + 8])] > 1:
                under.update(range(i, i + 8))
        lines = [x for x in (text or "").split("\n") if words(x)]
        expected = (
            len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(under)
        )
        assert word_statistics.statistics(text.encode() if text is not None else None) == expected


def test_quality_keeps_prose_and_rejects_symbols(spark, odd_docs, no_docs):
    rng = np.random.default_rng(2)
    prose = [" ".join(f"word{rng.integers(900)}" for _ in range(rng.integers(30, 300))) for _ in range(300)]
    junk = [" ".join(w + "$$$" for w in t.split()) for t in prose[:20]]
    docs = spark.createDataFrame(
        [(i, t, "en", f"s{i % 3}") for i, t in enumerate(prose + junk + ["short text"])],
        "doc_id long, text string, lang string, source string",
    )
    kept = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.quality_report(docs).collect()}
    assert all(kept[i] == (False, True) for i in range(300))
    assert all(kept[i] == (False, False) for i in range(300, 320))
    assert kept[320] == (True, False)
    report = quality_rules.quality_report(odd_docs).collect()
    assert len(report) == odd_docs.count()
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in report)
    good = quality_rules.good_documents(odd_docs)
    assert good.columns == odd_docs.columns and good.count() == sum(r.kept for r in report)
    assert quality_rules.quality_report(no_docs).count() == 0


def test_pieces_round_trip(odd_docs, no_docs, spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    odd = ["a ", " a", "a  b", "  ", "▁x ▁", "a\tb\n c", "\U0001f642 \U0001f642\U0001f642", "<s> </s>", "\x00a"]
    docs = odd_docs.select("doc_id", "text").union(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    )
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    expected = []
    for row in docs.collect():
        ids = model.encode(row.text or "")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), model.decode(ids))]
        expected.append((row.doc_id, len(ids), *digests, ids, model.decode(ids)))
    assert rows_of(pieces.encode_documents(docs, path)) == sorted(expected, key=repr)
    assert pieces.encode_documents(no_docs, path).count() == 0


def best_fit_by_force(items, capacity):
    open_bins = []
    for size in sorted(items, reverse=True):
        fits = [b for b in open_bins if sum(b) + size <= capacity]
        if fits:
            max(fits, key=sum).append(size)
        else:
            open_bins.append([size])
    return len(open_bins)


def test_bins_hold_all_items_and_no_more_than_best_fit():
    rng = np.random.default_rng(3)
    for _ in range(60):
        capacity = int(rng.integers(5, 60))
        items = rng.integers(1, capacity, rng.integers(1, 60))
        counts = np.bincount(items, minlength=capacity)
        assert bins.bins_of(bins.best_fit(counts, capacity)) == best_fit_by_force(items.tolist(), capacity)
        packed = bins.fewest_bins(counts, capacity)
        used = np.zeros(capacity, int)
        for filling, times in packed:
            assert sum(filling) <= capacity
            np.add.at(used, list(filling), times)
        assert (used == counts).all()
        assert bins.lower_bound(counts, capacity) <= bins.bins_of(packed) <= best_fit_by_force(items.tolist(), capacity)


def test_bin_completion_beats_best_fit_where_it_fails():
    counts = np.bincount([6, 5, 4, 3, 2] * 2 + [7, 3], minlength=11)  # 50 in bins of 10
    assert bins.bins_of(bins.fewest_bins(counts, 10)) == 5


def test_packing(odd_docs, no_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    found = packing.pack_documents(odd_docs, path).collect()
    expected = collections.Counter()
    for row in odd_docs.collect():
        ids = np.array(tokenizer.encode(row.text or "", add_special_tokens=False).ids + [2], "<u4")
        head = len(ids) % 1024 or 1024
        cuts = [0, *range(head, len(ids), 1024), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[row.doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in found)
    ends = collections.defaultdict(int)
    for row in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == ends[row.sequence_id]
        ends[row.sequence_id] += row.length
    assert max(ends.values()) <= 1024
    assert packing.pack_documents(no_docs, path).count() == 0


def test_token_ids_of_awkward_white_space():
    from duewatch.llm.tokens import ByteLevelIds

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids, plain = ByteLevelIds(path), tokenizers.Tokenizer.from_file(path)
    for text in ["a  b", "a \n b", "\n\n  x\ty ", " a", "a ", "  ", "it's  'll", "x  y", "x\x1c y", "a<|endoftext|>b c", "　 z 12 3", "é" * 300]:
        assert np.frombuffer(ids.of(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
