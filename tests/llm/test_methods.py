"""The methods inside the operators against brute force."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import LOW, WORD, documents, near_components

from plantmart.llm import bpe, jaccard, language_model, line_quality, packing, page_text, toxicity
from plantmart.llm.lexicon import Lexicon, build
from plantmart.llm.words import buffers, slices, word_slices, words_of

LETTERS = "abcdeéÀÿß×÷ \n\t'sreveltdm12²٣!?<|>ñ漢字🙂́ ǅ\x1c\x85\x00İΣσ½ªAZ"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=LETTERS, max_size=40), max_size=12), st.integers(1, 60))
def test_words_are_the_words_of_the_texts(texts, size):
    by_hash = defaultdict(set)
    at = 0
    for first, last, words in word_slices(pa.array(texts, pa.string()), size):
        assert first == at
        at = last
        for i in range(first, last):
            mine = words.text == i - first
            found = [bytes(words.data[a:b]).decode() for a, b in zip(words.start[mine], words.end[mine])]
            assert found == re.findall(WORD, texts[i])
            for word, number in zip(found, words.hash[mine]):
                by_hash[word.translate(LOW)].add(int(number))
    assert at == len(texts)
    assert all(len(v) == 1 for v in by_hash.values())
    assert len({next(iter(v)) for v in by_hash.values()}) == len(by_hash)


@pytest.fixture(scope="module")
def byte_level():
    from tokenizers import Tokenizer

    text = packing.tokenizer_text("byte_bpe_50k.json")
    return Tokenizer.from_str(text), bpe.Codec(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=LETTERS, max_size=60), st.booleans())
def test_byte_pairs_are_the_tokenizer_s(byte_level, text, special):
    whole, codec = byte_level
    text += "<|endoftext|>" * special + text[:3]
    ids = whole.encode(text, add_special_tokens=False).ids
    assert codec.encode_all([text])[0].tolist() == ids
    assert codec.decode(ids) == whole.decode(ids, skip_special_tokens=False)
    assert codec.decode(ids[1::2]) == whole.decode(ids[1::2], skip_special_tokens=False)


def test_long_words_are_merged_exactly(byte_level):
    whole, codec = byte_level
    for text in ("a" * 3000, "xyzabc" * 200, "é" * 500):
        assert codec.encode_all([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_word_ids_are_the_tokenizer_s():
    from tokenizers import Tokenizer

    text = packing.tokenizer_text("word_bpe_49k.json")
    whole, own = Tokenizer.from_str(text), packing.WordIds(text)
    pick = random.Random(5)
    texts = ["".join(pick.choices(LETTERS, k=pick.randint(0, 50))) for _ in range(1500)] + ["Zß" * 100, "<|startoftext|>a B"]
    for first, last, data, offsets in slices(pa.array(texts), 5000):
        flat, at = own.encode(data, offsets)
        for i in range(first, last):
            assert flat[at[i - first] : at[i - first + 1]].tolist() == whole.encode(texts[i], add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.binary(max_size=5), st.lists(st.integers(0, 3), max_size=3), max_size=40))
def test_lexicon_gives_back_its_entries(entries):
    words = sorted(entries)
    lexicon = Lexicon.mapped(build((w, tuple(entries[w])) for w in words))
    other = [w + b"q" for w in words if w + b"q" not in entries]
    found = lexicon.ids(words + other)
    assert [np.frombuffer(f, "<u4").tolist() for f in found[: len(words)]] == [entries[w] for w in words]
    assert found[len(words) :] == [None] * len(other)


def test_lexicon_shares_suffixes():
    words = sorted(a + b for a in (b"re", b"un", b"over", b"in") for b in (b"ing", b"ings", b"ed"))
    lexicon = Lexicon.mapped(build((w, (7,)) for w in words))
    assert len(lexicon.ends) < 16  # a tree would have one state for each of about 40 beginnings


def test_histogram_packing_puts_each_rank_in_one_place():
    pick = random.Random(1)
    for _ in range(100):
        counts = {pick.randint(1, 256): pick.randint(1, 60) for _ in range(pick.randint(1, 50))}
        runs = packing.pack_histogram(counts, 256)
        ranks, packs = defaultdict(list), defaultdict(list)
        for length, first, n, sequence, offset in runs:
            ranks[length].append((first, n))
            for j in range(n):
                packs[sequence + j].append((offset, length))
        for length, n in counts.items():
            assert [r for a, k in sorted(ranks[length]) for r in range(a, a + k)] == list(range(n))
        assert sorted(packs) == list(range(len(packs)))
        for held in packs.values():
            assert [o for o, _ in sorted(held)] == list(itertools.accumulate([0, *(x for _, x in sorted(held))]))[:-1]
            assert sum(x for _, x in held) <= 256


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=12), st.lists(st.sampled_from("abcde"), max_size=12))
def test_common_lines_are_a_longest_common_subsequence(a, b):
    longest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        longest[i + 1][j + 1] = longest[i][j] + 1 if a[i] == b[j] else max(longest[i][j + 1], longest[i + 1][j])
    found = sorted(page_text.common_lines(a, b))
    rest = iter(b)
    assert len(found) == longest[-1][-1] and all(a[i] in rest for i in found)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/apnvbr!-=\"' &;scriptdivclass", max_size=80))
def test_any_text_is_a_page(html):
    lines, main = page_text.page_lines(html)
    assert len(lines) == len(main) and all(line == " ".join(line.split()) != "" for line in lines)


def edited(pick, words, vocabulary, share):
    return [pick.choice(vocabulary) if pick.random() < share else w for w in words]


def near_copies(seed):
    """Chains and clusters of near copies, a shared passage, short texts and copies."""
    pick = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = pick.choices(vocabulary, k=40)
    texts = []
    for k in range(12):
        words = pick.choices(vocabulary, k=pick.choice([3, 5, 8, 30, 60, 120]))
        if k % 3 == 0:
            words = words[:10] + passage + words[10:]
        for _ in range(pick.choice([1, 2, 6, 25])):
            texts.append(" ".join(words))
            words = edited(pick, words, vocabulary, pick.choice([0, 0.005, 0.01, 0.03]))
    pick.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_links_every_pair_of_near_copies(ready, seed):
    rows = near_copies(seed)
    sizes, least, _ = near_components(rows, 4, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(documents(ready, rows)).collect()}
    assert got == {i: (s, c) for (i, _), s, c in zip(rows, sizes, least)}
    assert len(set(least)) < len(rows)


def test_later_levels_of_pivots_lose_no_link(ready):
    """One region whose members are only linked in pairs, so that first pivots settle nothing."""
    sets = {k: [*range(1000, 1060), *range(40 * (k // 2), 40 * (k // 2) + 40), 5000 + k] for k in range(40)}
    members = [(1, 1, k, len(v)) for k, v in sets.items()]
    regions = ready.createDataFrame(members, "shingle long, ring long, node long, n long")
    values = np.concatenate([np.array(v, np.uint64) for v in sets.values()])
    bits = jaccard.parities(values, np.cumsum([0, *map(len, sets.values())]))
    kinds = ", ".join(f"{b} long" for b in jaccard.BITS)
    rows = [(k, v, *map(int, b)) for (k, v), b in zip(sets.items(), bits)]
    held = ready.createDataFrame(rows, f"node long, set array<long>, {kinds}")
    edges = jaccard.links(regions, held, percent=85, growth=3)
    found = {r["node"]: r["label"] for r in jaccard.components(edges).collect()}
    assert found == {k: k // 2 * 2 for k in sets}


def test_a_few_strangers_in_a_dense_group_cost_one_level(ready, monkeypatch):
    sets = {k: [*range(100), 1000 + k] for k in range(60)} | {k: [*range(40), *range(100 * k, 100 * k + 61)] for k in range(100, 103)}
    regions = ready.createDataFrame([(1, 1, k, len(v)) for k, v in sets.items()], "shingle long, ring long, node long, n long")
    values = np.concatenate([np.array(v, np.uint64) for v in sets.values()])
    bits = jaccard.parities(values, np.cumsum([0, *map(len, sets.values())]))
    rows = [(k, v, *map(int, b)) for (k, v), b in zip(sets.items(), bits)]
    held = ready.createDataFrame(rows, f"node long, set array<long>, {', '.join(f'{b} long' for b in jaccard.BITS)}")
    levels, inner = [], jaccard.measured
    monkeypatch.setattr(jaccard, "measured", lambda *a: levels.append(1) or inner(*a))
    found = {r["node"]: r["label"] for r in jaccard.components(jaccard.links(regions, held, growth=3)).collect()}
    assert {k: found.get(k, k) for k in sets} == {k: 0 if k < 60 else k for k in sets}
    # The first pivot, pivots until one is in the group, and the strangers: not a level for each power of three up to the region's size.
    assert len(levels) <= 3


def test_components_of_chains(ready):
    pick = random.Random(4)
    chain = pick.sample(range(1000), 60)
    edges = list(zip(chain, chain[1:])) + [(2000, 2001), (2001, 2000), (3000, 3000)]
    got = {r["node"]: r["label"] for r in jaccard.components(ready.createDataFrame(edges, "a long, b long")).collect()}
    assert got == dict.fromkeys(chain, min(chain)) | {2000: 2000, 2001: 2000, 3000: 3000}


def test_language_model_is_the_backed_off_one(ready):
    pick = random.Random(2)
    vocabulary = [f"w{k}" for k in range(30)]
    text = [" ".join(pick.choices(vocabulary, weights=range(1, 31), k=pick.choice([0, 1, 2, 40, 1200]))) for _ in range(40)]
    rows = list(enumerate(text))
    train, least, d = rows[:30], 2.0, language_model.DISCOUNT
    tokens = {i: [*t.split(), None] for i, t in rows}
    one = Counter(x for i, _ in train for x in tokens[i])
    total, distinct = sum(one.values()), len(one)
    often = {w for w, n in one.items() if n >= least}
    grams = [{(w,): n for w, n in one.items() if w in often}]
    for size in (2, 3):
        count = Counter()
        for i, _ in train:
            for k in range(len(tokens[i]) - size + 1):
                gram = tuple(tokens[i][k : k + size])
                if gram[:-1] in grams[-1] and gram[1:] in grams[-1]:
                    count[gram] += 1
        grams.append({g: n for g, n in count.items() if n >= least})

    def probability(history, word):
        if not history:
            return (one[word] - d) / total if one[word] else d * distinct / total
        level = len(history)
        lower = lambda w: probability(history[1:], w)
        if history not in grams[level - 1]:
            return lower(word)
        if (*history, word) in grams[level]:
            return (grams[level][*history, word] - d) / grams[level - 1][history]
        if history not in rests:
            kept = [g[-1] for g in grams[level] if g[:-1] == history]
            given = sum((grams[level][*history, w] - d) / grams[level - 1][history] for w in kept)
            rests[history] = (1 - given) / (1 - sum(lower(w) for w in kept))
        return rests[history] * lower(word)

    rests: dict = {}
    model, counts = language_model.learn(documents(ready, train, []))
    got = {r["doc_id"]: r["score"] for r in language_model.score(documents(ready, rows, []), model, counts).collect()}
    for i, words in tokens.items():
        want = sum(math.log10(probability(tuple(words[max(0, k - 2) : k]), w)) for k, w in enumerate(words))
        assert got[i] == pytest.approx(want, rel=1e-9)
    for history in [(), *pick.sample(sorted(k for k in grams[1] if None not in k), 5)]:
        assert sum(probability(history, w) for w in [*one, "never seen"]) == pytest.approx(1)


def test_field_s_probabilities_are_those_of_all_labellings():
    random_ = np.random.default_rng(1)
    text = np.array([0, 0, 0, 0, 2, 2, 3])
    evidence = random_.normal(0, 1, len(text))
    field = line_quality.Field(np.zeros(1), np.zeros(0), np.ones(0), np.array([0.7, 1.3]), 1.0, 0.0, 0.5)
    forward, backward = field.odds(evidence, line_quality.chains(text, 4))
    got = 1 / (1 + np.exp(-(forward + backward)))
    for t in (0, 2, 3):
        at = np.flatnonzero(text == t)
        good, whole = np.zeros(len(at)), 0.0
        for labels in itertools.product((0, 1), repeat=len(at)):
            value = sum(evidence[i] * y for i, y in zip(at, labels))
            value += sum(field.stay[a] for a, b in zip(labels, labels[1:]) if a == b)
            whole += math.exp(value)
            good += math.exp(value) * np.array(labels)
        assert np.allclose(got[at], good / whole)


def test_filters_see_every_window():
    """The network's values from windows with a known word equal those over all windows of the text."""
    random_ = np.random.default_rng(3)
    texts = ["a b c d e f", "", "x x x", "c", "a b"]
    words = words_of(*buffers(pa.array(texts)))
    known = np.unique(toxicity.buckets(words, np.array([0, 2, 3])))
    vocabulary = toxicity.Vocabulary(known)
    net = toxicity.Network(
        vocabulary, np.vstack([random_.normal(0, 1, (len(known), toxicity.SIZE)), np.zeros((1, toxicity.SIZE))]),
        [random_.normal(0, 1, (w, toxicity.SIZE, toxicity.FILTERS)) for w in toxicity.WIDTHS],
        [random_.normal(0, 1, toxicity.FILTERS) for _ in toxicity.WIDTHS], np.zeros(0), 0.0, np.zeros(5),
    )
    table, kind = toxicity.kinds_of(words, vocabulary)
    got, _ = net.pooled(net.vectors[table].sum(1), toxicity.windows_of(kind, words.text, words.n, len(table) - 1))
    vector = net.vectors[vocabulary.rows(toxicity.buckets(words, np.arange(len(words.hash))))].sum(1)
    for t in range(len(texts)):
        own = [*vector[words.text == t], *np.zeros((2, toxicity.SIZE))]
        at = 0
        for filters, bias in zip(net.filters, net.bias):
            width = len(filters)
            all_windows = [sum(own[i + j] @ filters[j] for j in range(width)) + bias for i in range(len(own) - width + 1)] + [bias]
            assert np.allclose(got[t, at : at + toxicity.FILTERS], np.maximum(np.max(all_windows, 0), 0))
            at += toxicity.FILTERS
