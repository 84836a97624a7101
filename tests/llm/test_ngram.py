"""How prefix tokens travel and which pairs they make."""

import numpy as np
import pandas as pd

from aerowx.llm import ngram_join as nj
from aerowx.llm.runs import unpacked
from aerowx.llm.words import shingle_set, text_words

PERCENT = 85


class Flat:
    value = np.zeros(nj.CELLS, np.uint8)


def emitted(texts, orders=range(1), buckets=16):
    emit = nj._prefixes(4, PERCENT, Flat, orders, buckets)
    return pd.concat(list(emit(iter([pd.DataFrame({"text": texts})]))), ignore_index=True)


def masks(frame):
    found = {}
    ordered = frame.sort_values("bucket", kind="stable", ignore_index=True)
    for pairs in nj._pair_up(PERCENT)(iter([ordered])):
        for mask, a, b in zip(pairs["mask"], pairs["a"], pairs["b"]):
            found[a, b] = found.get((a, b), 0) | int(mask)
    return found


def nodes(texts):
    return [nj._node(nj._digest(shingle_set(w, 4))) for w in text_words(texts)]


def test_prefix_tokens_travel_packed():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 200)) for _ in range(300)]
    frame = emitted(texts)
    count = 300 * nj.prefix_length(197, PERCENT)
    width = sum(np.dtype(k).itemsize for k in nj._PACKED)
    assert len(frame) <= 16 and frame["bucket"].is_unique
    assert abs(frame["entries"].map(len).sum() - width * count) <= width * 300
    want, got = {}, {}
    for node, words in zip(nodes(texts), text_words(texts)):
        tokens = shingle_set(words, 4)
        order = np.argsort(nj._order_key(tokens, Flat.value, 0))[: nj.prefix_length(len(tokens), PERCENT)]
        want[node] = [(int(t) >> 16 << 2, len(tokens), k) for k, t in enumerate(tokens[order])]
    for bucket, blob in zip(frame["bucket"], frame["entries"]):
        token, node, n, place, tied = unpacked(blob, nj._PACKED)
        token = np.cumsum(token, dtype=np.uint64)
        assert not tied.any() and {(int(t) >> 18) * 16 >> 32 for t in token} == {bucket}
        for row in zip(token.tolist(), node.tolist(), n.tolist(), place.tolist()):
            got.setdefault(row[1], []).append((row[0], row[2], row[3]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_a_late_shared_token_makes_no_pair():
    # One shared shingle in 61: a pair only where its places leave room for the intersection.
    rng = np.random.default_rng(4)
    made = 0
    for trial in range(60):
        x, y = ([f"{side}{trial}_{k}" for k in range(64)] for side in "xy")
        y[30:34] = x[30:34]
        texts = [" ".join(x), " ".join(y)]
        keys = [nj._order_key(s, Flat.value, 0) for s in (shingle_set(w, 4) for w in text_words(texts))]
        shared = np.intersect1d(*keys)
        places = [int((k < shared[0]).sum()) for k in keys]
        least = -(-PERCENT * 122 // (100 + PERCENT))
        want = max(places) <= 61 - least
        assert bool(masks(emitted(texts))) == want
        made += want
    assert made < 10


def test_links_are_pairs_under_every_order_or_ties():
    rng = np.random.default_rng(5)
    base = [f"b{k}" for k in range(120)]
    near = []
    for k in range(12):
        words = list(base)
        words[int(rng.integers(0, 120))] = f"u{k}"
        near.append(" ".join(words))
    crowd = [" ".join([*(f"c{k}" for k in range(60)), f"v{k}"]) for k in range(nj.FEW + 20)]
    for texts, reads in ((near, 1), (crowd, 1), (crowd, 3)):
        # As one task, and as several that each hold a part of the documents.
        frames = [emitted(texts[k::reads], range(nj.ORDERS)) for k in range(reads)]
        found, own = masks(pd.concat(frames, ignore_index=True)), nodes(texts)
        sets = dict(zip(own, (shingle_set(w, 4) for w in text_words(texts))))
        tied = {frozenset(p) for p, mask in found.items() if mask & nj.TIE}
        groups = {n: {n} for n in own}
        for pair in tied:
            joined = set().union(*(groups[n] for n in pair))
            for n in joined:
                groups[n] = joined
        for a in own:
            for b in own:
                both = len(np.intersect1d(sets[a], sets[b]))
                if a > b and 100 * both >= PERCENT * (len(sets[a]) + len(sets[b]) - both):
                    assert found.get((a, b), 0) & (nj.TIE - 1) == nj.TIE - 1 or b in groups[a]


def test_the_sketch_grows_with_the_text():
    gigabyte = 1 << 30
    sizes = [nj.sketch_cells(k * gigabyte) for k in (0, 1, 4, 40)]
    assert sizes == [nj.CELLS, 1 << 23, 1 << 25, nj.MOST_CELLS]
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 100)) for _ in range(20)]
    for cells in (nj.CELLS, 2 * nj.CELLS):
        *rows, last = nj._scan(4, cells)(iter([pd.DataFrame({"doc_id": ["1"] * 20, "text": texts})]))
        levels = np.zeros(cells, np.int64)
        for share, blob in zip(last["share"], last["counts"]):
            levels[share * nj._SHARE : (share + 1) * nj._SHARE] = nj._blob_counts(blob)
        want = np.zeros(cells, np.int64)
        for words in text_words(texts):
            np.add.at(want, nj._cells(shingle_set(words, 4), cells), 1)
        assert (levels == want).all()


def test_counts_of_a_share_keep_their_values():
    for largest in (1, 255, 256, 70_000, (1 << 32) - 1):
        counts = np.zeros(nj._SHARE, np.uint32)
        counts[[0, 5, -1]] = largest, 1, largest
        assert (nj._blob_counts(nj._counts_blob(counts)) == counts).all()
