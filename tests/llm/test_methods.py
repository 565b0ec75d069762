"""Operators against plain versions on small tables."""

from __future__ import annotations

import inspect
import math
import random
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from corpus_fixtures import prose  # noqa: F401

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from obsloom.llm import automaton, bpe, chaining, lm, suffix
from obsloom.llm.lines import dedup_lines
from obsloom.llm.minhash import across, cell_links, least_matches, near_duplicates, shingle_sets, signature
from obsloom.llm.mixing import annotated, mix, rake
from obsloom.llm.queries import vocabulary_path
from obsloom.llm.vectors import near_vectors


def roots(ids, links):
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.fixture(scope="module")
def near_texts(prose):
    """Chains of near copies, copies in another case and spacing, and texts of their own."""
    draw, texts = random.Random(3), {}
    for i in range(60):
        words = prose(i % 12, 120).split()
        for _ in range(draw.randrange(0, 5)):
            words[draw.randrange(120)] = f"new{draw.randrange(10**6)}"
        texts[i] = ("\n " if i % 7 == 0 else " ").join(words)
    texts |= {60: texts[1].upper(), 61: prose(99, 3), 62: prose(99, 3), 63: None, 64: "", 65: prose(100, 700)}
    return texts


def test_minhash_equals_all_pairs(spark, near_texts):
    docs = spark.createDataFrame(list(near_texts.items()), "doc_id long, text string")
    sets = {i: shingles(t) for i, t in near_texts.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = roots(sets, links)
    for r in near_duplicates(docs).collect():
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (want[r["doc_id"]] == r["doc_id"])


@pytest.mark.parametrize("block", [512, 7])
def test_cells_give_linear_links_that_miss_nothing(spark, prose, block):
    """One large group of near copies over three components and many single ones: at most n - 1 links a cell, all components right."""
    draw, base, sets = random.Random(5), prose(1, 200).split(), {}
    for i in range(160):
        words = list(base)
        for _ in range(draw.randrange(1, 16)):
            words[draw.randrange(200)] = f"x{draw.randrange(10**6)}"
        sets[i] = shingle_sets([" ".join(words)])[0]
    similar = lambda a, b: 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))
    links = [(a, b) for a in sets for b in sets if a < b and similar(a, b)]
    comp = {i: (i % 3 if i < 90 else i) for i in sets}
    want = roots(sets, [*links, *comp.items()])
    rows = []
    for i, x in sets.items():
        bands = signature(x).reshape(32, 4)
        rows += [(hash((k, bands[k].tobytes())), k, i, comp[i], bytearray(signature(x).tobytes()), bytearray(x.tobytes())) for k in range(32)]
    cells = spark.createDataFrame(rows, "bucket long, band int, id long, comp long, sig binary, set binary")
    buckets, kinds = cells.select("bucket", "band", "id", "comp"), cells.select("id", "sig", "set").dropDuplicates(["id"])
    got = [(r["a"], r["b"]) for r in across(buckets, kinds, 75, 1e-6, block=block).collect()]
    assert all(similar(a, b) and comp[a] != comp[b] for a, b in got)
    assert roots(sets, [*got, *comp.items()]) == want and len(links) > 900
    if block == 512:
        assert len(got) < 32 * len(set(comp.values()))
    one = [r for r in rows if r[1] == 0]
    for bucket in {r[0] for r in one}:
        own = [r for r in one if r[0] == bucket]
        columns = [np.array([r[k] for r in own]) for k in (2, 3)]
        found = cell_links(*columns, np.stack([np.frombuffer(bytes(r[4]), np.uint32) for r in own]), [np.frombuffer(bytes(r[5]), np.uint64) for r in own], np.full(len(own), 2), 0, least_matches(0.75, 1e-6), 75)
        assert len(found) < max(len(set(columns[1])), 1) + (not found)


def test_rows_that_repeat_an_id_join_their_classes(spark, prose):
    a, b, c = prose(21, 60), prose(22, 60), prose(23, 60)
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (7, b), (9, c), (9, None), (11, c)], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect()}
    assert got == {(3, 3, True), (5, 3, False), (7, 3, False), (9, 9, True), (11, 9, False)}


def test_vectors_equal_all_pairs(spark):
    random_ = np.random.default_rng(2)
    centres = random_.standard_normal((6, 16))
    vectors = [(i, (centres[i % 6] + random_.standard_normal(16) * 0.25).astype(np.float32).tolist(), i % 2) for i in range(150)]
    vectors += [(200 + i, vectors[i][1], vectors[i][2]) for i in range(10)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    units = {i: np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) for i, v, _ in vectors}
    label = {i: x for i, _, x in vectors}
    links = [(a, b) for a in units for b in units if a < b and label[a] == label[b] and units[a] @ units[b] >= 0.93]
    count, want = Counter(x for pair in links for x in pair), roots(units, links)
    for block in (1024, 8):
        for r in near_vectors(table, block=block).collect():
            assert (r["n_links"], r["component_id"]) == (count[r["vec_id"]], want[r["vec_id"]])


def test_projections_follow_from_rows_and_miss():
    """The stated chance of a miss holds, measured on pairs at the threshold, and chance meetings stay rare at any size."""
    from obsloom.llm.vectors import Hashes, agreement, plan

    random_ = np.random.default_rng(8)
    a, b = np.linalg.qr(random_.standard_normal((3000, 64, 2)))[0].transpose(2, 0, 1)
    near = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    for rows in (100, 5_000, 200_000):
        bits, tables = plan(rows, 0.93, 1e-2, 2.0, 8)
        hashes = Hashes(64, tables, bits, 2.0)
        same = (hashes.cells(a) == hashes.cells(near)).any(axis=1).mean()
        assert same >= 1 - 2 * 1e-2
        apart = (hashes.cells(a) == hashes.cells(b)).mean() * rows
        assert apart < 3 * 8 + 1 and agreement(0.0, 2.0) ** bits * rows <= 8.0001 or bits == 4
    assert plan(0, 0.93, 1e-4, 2.0, 8)[0] == 4 and plan(1_000, 1.0, 1e-4, 2.0, 8)[1] == 1


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    texts = ["", "  a  b\n\n c\t\td  ", "it's they'll 'S don't  ", "<|endoftext|>", "x<|endoftext|> y <|endoftext|><|endoftext|>\n", "日本語 テスト　全角\xa0nb\x85nel",
             "é ñ 😀😀 a😀b", " \x1c\x1d x \x1f", "123 456abc ½ ² ٣", "a" * 3000, "\n" * 50 + "x", "the cat the cat the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for lexicon in (None, bpe.build_lexicon(docs, vocabulary_path(), max_words=0)):
        coded = bpe.encode(docs, vocabulary_path(), lexicon, decoded=True)
        for r in coded.collect():
            want = library.encode(r["text"], add_special_tokens=False).ids
            assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False) == r["text"]
    for r in bpe.decode(coded.drop("decoded"), vocabulary_path()).collect():
        assert r["decoded"] == r["text"]


def test_automaton_shares_suffixes(tmp_path):
    words = sorted({w.encode() for w in "tap taps top tops stop stops caps cap a ab é".split()})
    automaton.save(automaton.build(words, ([i, i + 1] for i in range(len(words)))), str(tmp_path / "a"))
    arrays = automaton.load(str(tmp_path / "a"))
    asked = [*words, b"", b"t", b"tapss", b"zzz", b"\xc3"]
    data, sizes = np.frombuffer(b"".join(asked), np.uint8), np.array([len(w) for w in asked])
    assert automaton.ranks(arrays, data, np.cumsum(sizes) - sizes, sizes).tolist() == [*range(len(words)), -1, -1, -1, -1, -1]
    assert arrays["outputs"][arrays["offsets"][3] : arrays["offsets"][4]].tolist() == [3, 4]
    assert len(arrays["final"]) < len({w[:i] for w in words for i in range(len(w) + 1)})  # fewer states than prefixes


def brute_starts(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    return [[i <= len(t) - length and count[t[i : i + length]] > 1 for i in range(len(t))] for t in texts]


@pytest.mark.parametrize("length", [5, 12, 40])
def test_expansion_finds_repeated_starts(length):
    draw = random.Random(length)
    for letters in (b"ab", b"abcd", bytes(range(97, 117))):
        texts = [bytes(draw.choice(letters) for _ in range(draw.randrange(1, 120))) for _ in range(6)]
        texts += [texts[0][:50] + texts[1][-60:], texts[2], b"a" * 90]
        joined = np.concatenate([np.append(np.frombuffer(t, np.uint8).astype(np.int16) + 1, 0) for t in texts]).astype(np.int16)
        assert suffix.shared_starts(joined, length).tolist() == [x for own in brute_starts(texts, length) for x in [*own, False]]


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_substrings_equal_brute_force(spark, prose, block_bytes):
    passage, short = prose(50, 90), prose(51, 40)
    texts = [prose(i, 150) for i in range(6)]
    texts += [texts[0][:300] + passage + texts[1], passage, texts[2] + " é " + passage, short, short, passage[:399], "ab" * 600, texts[3] + texts[3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    data = [t.encode() for t in texts]
    starts = brute_starts(data, 400)
    for r in suffix.repeated_substrings(docs, block_bytes=block_bytes).collect():
        t, hit = data[r["doc_id"]], np.zeros(len(data[r["doc_id"]]), bool)
        for i in np.flatnonzero(starts[r["doc_id"]]):
            hit[i : i + 400] = True
        assert bytes(r["kept"]) == bytes(np.frombuffer(t, np.uint8)[~hit]) and r["n_removed"] == hit.sum()
        assert len(r["spans"]) == (np.diff(np.append(0, hit.astype(int))) == 1).sum()


def test_lines_equal_plain_rule(spark):
    draw = random.Random(5)
    pool = [f"Line {i} that is surely longer than forty code points, é" for i in range(8)] + ["short line", "", "  "]
    texts = [(i, "\n".join(f"{draw.choice(['', ' '])}{draw.choice(pool)}" if draw.random() < 0.7 else f"own {i} {draw.random()} " + "x" * 40 for _ in range(draw.randrange(0, 9)))) for i in range(40)]
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in texts:
        for line in t.split("\n"):
            holders[key(line)].add(i)
    gone = {k: max(d) for k, d in holders.items() if len(k) >= 40 and len(d) >= 5}
    assert gone
    for batches, fanout in ((1, 2), (4, 2), (5, 3)):
        for r in dedup_lines(spark.createDataFrame(texts, "doc_id long, text string"), batches=batches, fanout=fanout).collect():
            lines = dict(texts)[r["doc_id"]].split("\n")
            left = [x for x in lines if gone.get(key(x), r["doc_id"]) == r["doc_id"]]
            assert r["text"] == "\n".join(left) and (r["n_lines"], r["n_dropped"]) == (len(lines), len(lines) - len(left))


def test_mixing_meets_targets(spark):
    rows = [(i, "word " * (1 + i % 5), f"s{i % 3 if i % 2 else 0}", "en" if i % 7 < 5 else "fr") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = {"source": {"s0": 1, "s1": 1, "s2": 2}, "lang": {"en": 0.5, "fr": 0.5}, "topic": 1.0}
    mixed = mix(annotated(docs), targets, keep_share=0.2, sweeps=30).collect()
    total = sum(r["n_tokens"] for r in mixed)
    expected = sum(r["n_tokens"] * r["probability"] for r in mixed)
    assert expected == pytest.approx(0.2 * total)
    for margin, want in (("source", {"s0": 0.25, "s1": 0.25, "s2": 0.5}), ("lang", {"en": 0.5, "fr": 0.5})):
        for value, share in want.items():
            raked = sum(r["n_tokens"] * r["weight"] for r in mixed if r[margin] == value) / total
            kept = sum(r["n_tokens"] for r in mixed if r[margin] == value and r["kept"]) / sum(r["n_tokens"] for r in mixed if r["kept"])
            assert raked == pytest.approx(share, abs=1e-3) and kept == pytest.approx(share, abs=0.12)


def test_rake_is_exact_on_one_margin(spark):
    cells = spark.createDataFrame([("a", "x", 10), ("a", "y", 30), ("b", "x", 60)], "source string, lang string, tokens long")
    got = {(r["source"], r["lang"]): r["weight"] for r in rake(cells, {"source": {"a": 1, "b": 3}}, 1).collect()}
    assert got == pytest.approx({("a", "x"): 0.0625, ("a", "y"): 0.1875, ("b", "x"): 0.75})


def test_chains_equal_quadratic_form():
    draw = random.Random(4)
    for _ in range(60):
        pairs = sorted({(draw.randrange(60), draw.randrange(60)) for _ in range(draw.randrange(1, 40))})
        pos, other = np.array([p for p, _ in pairs]), np.array([q for _, q in pairs])
        for cost in (0.0, chaining.GAP_COST):
            found = chaining.chains(pos, other, gap_cost=cost)
            assert sorted(i for c in found for i in c) == list(range(len(pairs)))
            for c in found:
                assert all(pos[a] < pos[b] and other[a] < other[b] for a, b in zip(c, c[1:], strict=False))
        longest = []  # without gap costs the best chain is the longest, found here by looking at all predecessors
        for i, (p, q) in enumerate(pairs):
            longest.append(1 + max((longest[j] for j in range(i) if pairs[j][0] < p and pairs[j][1] < q), default=0))
        assert len(chaining.chains(pos, other, gap_cost=0.0)[0]) == max(longest)


def test_passages_with_edits(spark, prose):
    passage = prose(70, 80).split()
    edited = [w if i % 23 else f"edit{i}" for i, w in enumerate(passage)]
    texts = [prose(71, 100) + " " + " ".join(passage), " ".join(edited) + " " + prose(72, 90), prose(73, 200), " ".join(passage[:30]) + " " + prose(74, 60)]
    got = {r["doc_id"]: r for r in chaining.fuzzy_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i]["n_removed"] for i in (0, 2, 3)] == [0, 0, 0]
    assert 70 <= got[1]["n_removed"] <= 84 and got[1]["first_docs"] == [0]


def test_lm_base_and_held_out(spark, prose):
    texts = [(i, ("the cat sat on the mat and " * (i % 5 + 1) + prose(i % 30, 20)).strip()) for i in range(80)] + [(80, None), (81, "")]
    rows = {r["doc_id"]: r for r in lm.lm_scores(spark.createDataFrame(texts, "doc_id long, text string"), vocabulary_path("byte_bpe_50k.tiktoken"), train_every=1).collect()}
    words = {i: [*(t or "").lower().split(), None] for i, t in texts}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    count = Counter(w for i, own in words.items() if not held[i] for w in own)
    n, v = sum(count.values()), len(count)
    for i, own in words.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(own), sum(count[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own))
    some = [i for i in rows if held[i]]
    even = sum(len(words[i]) for i in some) * -math.log10(50_257)
    assert even < sum(rows[i]["score"] for i in some) < 0


def test_lm_words_move_once(spark):
    """The sum over all blocks comes beside each block's word by one exchange, and words of held-out documents alone have no row."""
    words = spark.createDataFrame([("a", 1, 0, 2), ("a", 2, 5, 0), ("b", 1, 1, 0), ("b", 2, 6, 0), ("c", 2, 7, 3)], "word string, block long, i int, n long")
    got = lm.word_counts(words)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, got.collect())) == [(1, 0, 2, True), (2, 5, 2, False), (2, 7, 3, True)]


def test_lm_gradients_and_windows():
    model = lm.Model(np.random.default_rng(1).integers(0, 50, lm.VOCABULARY).astype(float))
    random_ = np.random.default_rng(2)
    x, y = random_.integers(0, lm.READ_CLASSES + 1, (3, lm.WINDOW)), random_.integers(0, lm.CLASSES, (3, lm.WINDOW))
    used = random_.random((3, lm.WINDOW)) < 0.7

    def loss():
        first = lm.WINDOW - lm.SCORED
        return -model.score(x, y[:, first:])[used[:, first:]].mean()

    only_scored = used.copy()
    only_scored[:, : lm.WINDOW - lm.SCORED] = False
    grad = model.gradients(x, y, only_scored)
    for name in ("E", "P", "Q", "K", "V", "O", "o"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        old = model.weights[name][at]
        model.weights[name][at] = old + 1e-2
        up = loss()
        model.weights[name][at] = old - 1e-2
        down = loss()
        model.weights[name][at] = old
        assert (up - down) / 2e-2 == pytest.approx(grad[name][at], rel=0.05, abs=2e-4)


def test_lm_trains_on_every_window_once():
    """With the parameters of the query; a step gathers no more than its own windows."""
    every = inspect.signature(lm.lm_scores).parameters["train_every"].default
    sizes = [5, 700, 0, 90, 33]
    row = {
        "sizes": sizes, "held": [False, False, False, True, False], "text": lm._pack(np.arange(sum(sizes), dtype=np.uint32) % 50),
        "lengths": lm._pack(np.full(50, 2, np.uint32)), "ids": lm._pack(np.arange(100, dtype=np.uint16)),
    }
    seen, largest = 0, 0

    class Spy(lm.Model):
        def gradients(self, x, y, used):
            nonlocal seen, largest
            seen, largest = seen + int(used.sum()), max(largest, len(x))
            return super().gradients(x, y, used)

    windows = [lm.learned_block(lm.Texts(row), Spy(np.ones(lm.VOCABULARY)), number, 2, every, least_steps=1) for number in range(2)]
    places = [2 * n + 1 for n, held in zip(sizes, row["held"], strict=True) if not held]
    assert seen == sum(places) and sum(windows) == sum(-(-n // lm.SCORED) for n in places) and largest <= lm.LEARN_BATCH


def test_lm_score_is_the_networks_distribution_over_ids(spark):
    """Probabilities of all ids sum to 1, those in a class depend on the context, and known words take theirs from it."""
    model = lm.Model(np.random.default_rng(3).integers(0, 50, lm.VOCABULARY).astype(float))
    x = np.random.default_rng(4).integers(0, lm.READ_CLASSES, (2, lm.WINDOW))
    every = np.arange(lm.VOCABULARY)
    logs = []
    for own in x:  # all ids at one place: the last
        y = np.tile(every[:, None], (1, lm.SCORED))
        logs.append(np.concatenate([model.score(np.tile(own, (len(part), 1)), part)[:, -1] for part in np.array_split(y, 13)]))
        assert np.exp(logs[-1].astype(float)).sum() == pytest.approx(1, abs=1e-3)
    same = model.written == np.bincount(model.written).argmax()
    within = [np.exp(row[same] - row[same].max()) for row in logs]
    assert np.abs(within[0] / within[0].sum() - within[1] / within[1].sum()).max() > 1e-6
    draw = random.Random(6)
    follows = {"alpha": "beta", "gamma": "delta"}  # equally frequent words, told apart by the one before
    texts = [(i, " ".join(w for a in draw.choices(list(follows), k=30) for w in (a, follows[a]))) for i in range(60)]
    pairs = [(1000, "alpha beta " * 20), (1001, "alpha delta " * 20)]
    rows = spark.createDataFrame(texts + pairs, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm.lm_scores(rows, vocabulary_path("byte_bpe_50k.tiktoken"), least_steps=300).collect()}
    assert got[1000] > got[1001] + 5


def test_passages_at_least_identity(spark):
    """Ten of fifty words replaced: every passage is found, as trying all pairs and diagonals finds them."""
    draw, texts, own = random.Random(8), [], iter(range(10**9))
    fresh = lambda n: [f"u{next(own)}" for _ in range(n)]
    for _ in range(60):
        passage = fresh(50)
        gone = set(draw.sample(range(1, 49), 10))
        texts.append(fresh(30) + passage + fresh(30))
        texts.append(fresh(40) + [f"e{next(own)}" if i in gone else w for i, w in enumerate(passage)] + fresh(20))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in chaining.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["n_removed"] == (50 if i % 2 else 0) and got[i]["first_docs"] == ([i - 1] if i % 2 else []) for i in got)


def test_passages_whose_pieces_stand_in_earlier_documents(spark):
    """A passage of two sentences, each also alone in earlier documents: few of them, and more than are matched in pairs."""
    own = iter(range(10**9))
    fresh = lambda n: [f"u{next(own)}" for _ in range(n)]
    for before in (1, chaining.FEW + 4):
        texts, want = [], set()
        for _ in range(8):
            a, b = fresh(30), fresh(30)
            texts += [fresh(20) + piece + fresh(20) for piece in (a, b) for _ in range(before)]
            texts += [fresh(20) + a + b + fresh(20), fresh(25) + a + b + fresh(15)]
            want.add(len(texts) - 1)
        rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
        got = chaining.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").collect()
        assert {r["doc_id"]: (r["n_removed"], r["first_docs"]) for r in got} == {i: (60, [i - 1]) for i in want}


def test_lm_texts_take_few_bytes_an_id():
    """Besides the ids, two bytes each, and the words, no array as long as the ids is made; each word's ids and each text's end are there."""
    draw = np.random.default_rng(7)
    sizes, lengths = [4_000, 0, 496_000], draw.integers(1, 9, 500).astype(np.uint32)
    words, ids = draw.integers(0, 500, sum(sizes)).astype(np.uint32), draw.integers(0, lm.END, int(lengths.sum())).astype(np.uint16)
    row = {"sizes": sizes, "held": [False] * 3, "text": lm._pack(words), "lengths": lm._pack(lengths), "ids": lm._pack(ids)}
    tracemalloc.start()
    texts = lm.Texts(row)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    own, ends, want = np.split(ids, np.cumsum(lengths)[:-1]), np.cumsum(sizes).tolist(), []
    for a, b in zip([0, *ends], ends, strict=False):
        want += [i for w in words[a:b] for i in own[w].tolist()] + [lm.END]
    assert texts.ids.tolist() == want and peak < 16 * len(want)


def test_lm_updates_of_neighbouring_classes_are_one():
    ones = [(low, high, np.full((high - low, 2), low), np.full(high - low, high)) for low, high in ((0, 3), (3, 4), (6, 8))]
    got = lm._neighbours(ones)
    assert [g[:2] for g in got] == [(0, 4), (6, 8)] and got[0][2].tolist() == [[0, 0]] * 3 + [[3, 3]] and got[0][3].tolist() == [3, 3, 3, 4]
    assert lm._neighbours([]) == []


def test_passage_seeds_packed():
    """The packed places of seeds, of several tasks, say the same as all places at hand; most places of a seed in every text go to any bucket."""
    draw, rows, places = np.random.default_rng(9), [], {}
    for task in range(3):
        seeds = np.concatenate([draw.integers(0, 400, 900).astype(np.uint64) << np.uint64(54), np.full(300, 5 << 60, np.uint64), np.full(60, (7 << 60) + task, np.uint64)])
        docs, at = draw.integers(-4, 1 << 40, len(seeds)), draw.integers(0, 900, len(seeds)).astype(np.int32)
        docs[-60:] = 11 + task  # seeds of one document
        for seed, doc, place in zip(seeds.view(np.int64).tolist(), docs.tolist(), at.tolist(), strict=True):
            places.setdefault(seed, []).append((doc, place))
        rows += chaining.dealt_rows(seeds, docs, at, 8)
    paired, first, all_, homes = {}, {}, {}, {}
    for bucket in range(8):
        some = [r for r in rows if r["bucket"] == bucket]
        columns = [c.to_pylist() for c in chaining.grouped_places(some)] if some else [[]] * 6
        for kind, seed, doc, place, docs, at in zip(*columns, strict=True):
            own = list(zip(docs, at, strict=True))
            if kind == chaining.PAIRED:
                paired[seed] = sorted(own)
            elif kind == chaining.HOME:
                homes[seed] = (doc, place)
            else:
                all_.setdefault(seed, []).extend(own)
                if kind == chaining.FREQUENT:
                    first[seed] = (doc, place)
                    assert len(own) <= 3 * (chaining.FEW + 1) or len(places[seed]) == len(own)
    shared = {seed: sorted(own) for seed, own in places.items() if len({doc for doc, _ in own}) > 1}
    many = {seed: own for seed, own in shared.items() if len(own) > chaining.FEW}
    assert paired == {seed: own for seed, own in shared.items() if seed not in many}
    assert first == homes == {seed: own[0] for seed, own in many.items()}
    assert {seed: sorted(all_[seed]) for seed in many} == many and len(many) >= 1


def test_passages_move_no_texts_for_counts(spark, monkeypatch):
    """Where the text is not asked for, it is not moved with the result; stored steps leave no shuffle files."""
    released = []
    kept = chaining.stored
    monkeypatch.setattr(chaining, "stored", lambda df, **options: released.append(options.get("release")) or kept(df, **options))
    docs = spark.createDataFrame([(i, f"{i} " + "one two three four five six " * 12) for i in range(4)], "doc_id long, text string")
    got = chaining.fuzzy_passages(docs).select("doc_id", "n_words", "n_removed")
    above, below = got._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter", 1)
    assert released and all(released) and "regexp_" in below and "regexp_" not in above and "text#" not in above
    assert [r["n_words"] for r in got.orderBy("doc_id").collect()] == [73] * 4
