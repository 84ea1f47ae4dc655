"""The operators' methods on small inputs, against brute force and the libraries themselves."""

import bisect
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from tapedeck.llm import ann, chat, html_text, langid, license_scan, packing, pieces, quality, secret_scan, simhash
from tapedeck.llm.common import WordTable

SPACE = r"[^\x20\x09-\x0D]+"


def words_of(rnd, n, letters="abcdefg"):
    return [" ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6))) for _ in range(n))][0]


def slow_fingerprint(text):
    low = text.translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(SPACE, low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_the_definition():
    rnd = random.Random(1)
    texts = [words_of(rnd, n) for n in (1, 2, 3, 4, 63, 64, 66, 300)] + ["", " \n", "ÀB\xa0c D\x1ce", "A\x0bB\x0cC  d"]
    assert [simhash.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]
    assert simhash.fingerprint(None) == 0


def test_embedding_distance_is_a_lower_bound_and_grids_miss_no_pair():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    for bits in (1, 2, 3):
        b = a.copy()
        for _ in range(bits):
            b ^= np.uint64(1) << rng.integers(0, 64, len(a)).astype(np.uint64)
        near = np.bitwise_count(simhash._embedding(a) ^ simhash._embedding(b))
        assert (near <= np.bitwise_count(a ^ b)).all()
        masks = [np.uint64(m % 2**64) for m in simhash._grid_masks(3)]
        same = [(simhash._embedding(a) & m) == (simhash._embedding(b) & m) for m in masks]
        assert np.any(same, axis=0).all()


def test_local_stars_connect_what_brute_force_connects():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40).astype(np.uint64)
    prints = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << np.uint64(k)) ^ (np.uint64(1) << np.uint64(2 * k)) for k in (1, 5, 9)]]))
    root, member = simhash.local_stars(prints.view(np.int64), 3)
    label = dict(zip(member.tolist(), root.tolist()))
    label = {p: label.get(p, p) for p in prints.view(np.int64).tolist()}
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 3
    reach = near
    for _ in range(6):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    values = [label[p] for p in prints.view(np.int64).tolist()]
    assert ((np.array(values)[:, None] == np.array(values)[None]) == reach).all()


def test_counts_of_a_text():
    text = "a b c a b c\n\n x# \nx\n x# \n"
    (n, chars, symbols, lines, repeated), _ = quality.statistics(text)
    assert (n, chars, symbols, lines, repeated) == (9, 11, 2, 1, 6)
    assert quality.statistics(None)[0] == [0] * 5
    rnd = random.Random(4)
    for _ in range(50):
        text = words_of(rnd, 30, "ab")
        words = text.split()
        windows = [tuple(words[i : i + 3]) for i in range(28)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        assert quality.statistics(text)[0][4] == len(covered)


def test_trees_learn_and_never_rise_with_a_falling_feature():
    rng = np.random.default_rng(5)
    x = rng.random((600, 2))
    y = ((x[:, 0] < 0.6) ^ (rng.random(600) < 0.1)).astype(float)
    trees = quality.fit_trees(x, y, [True, False])
    assert ((trees.score(x) > 0.5) == (x[:, 0] < 0.6)).mean() > 0.9
    for other in (0.1, 0.5, 0.9):
        line = trees.score(np.column_stack([np.linspace(0, 1, 200), np.full(200, other)]))
        assert (np.diff(line) <= 1e-12).all()
    assert quality.fit_trees(np.zeros((0, 2)), np.zeros(0), [True, False]).score(np.zeros((3, 2))).tolist() == [0.5] * 3


def test_phrases_are_longest_matches():
    samples = (("x", ("the cat sat on the mat", "a dog")), ("y", ("el gato come pan",)))
    model = langid.Automata(samples)

    def slow(text, own):
        symbols, count, at = langid.letters_of(text).tolist(), 0, 0
        sources = [langid.letters_of(t).tolist() for t in own]
        while at < len(symbols):
            size = 0
            while at + size < len(symbols) and any(symbols[at : at + size + 1] == s[i : i + size + 1] for s in sources for i in range(len(s))):
                size += 1
            at, count = at + max(size, 1), count + 1
        return count

    for text in ("the dog sat", "gato!! on pan", "zzz the mat", "cat"):
        symbols = model.symbols[langid.letters_of(text)]
        got = model.phrases(symbols[:, None], np.array([len(symbols)], np.int32))[:, 0]
        assert got.tolist() == [slow(text, own) for _, own in samples]
    langs, scores = model.score(["the cat", "come pan", None, "", "12 !", "the cat sat " * 100])
    assert langs == ["x", "y", "und", "und", "und", "x"] and scores[2:5] == [0, 0, 0] and all(0 <= s <= 1 for s in scores)
    assert langid.Automata(()).score(["abc"]) == (["und"], [0.0])


ALPHABET = [*"ab  \n\t▁é<>　ﬁ0Ａ'sʼ́\xa0\x00!?.-’中文🙂İΣς\x1c\x85", "<|endoftext|>", "<unk>", "<s>", "<0x0A>", " the", "ing"]


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path


def test_ids_equal_the_libraries(path):
    import sentencepiece
    import tokenizers

    sp, codec = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model")), pieces.Codec(path("piece_bpe_32k.model"))
    whole, table = tokenizers.Tokenizer.from_file(path("word_bpe_49k.json")), packing.Tokenizer(path("word_bpe_49k.json"))
    rnd = random.Random(6)
    for _ in range(1500):
        text = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14)))
        ids, decoded = codec.encode(text)
        want = [sp.bos_id(), *sp.encode(text), sp.eos_id()]
        assert np.frombuffer(ids, "<u4").tolist() == want and decoded == sp.decode(want), repr(text)
        assert np.frombuffer(table.encode(text), "<u4").tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0], repr(text)
    for _ in range(6000):  # words of letters with punctuation behind them
        text = "".join(rnd.choice("abÉßµªºÿ中Σςİı\u0338ñŸẞǅ") for _ in range(rnd.randint(1, 5))) + rnd.choice([".", "***", "'", "'s", "<|", ".\u0338", "!'re,", "1."])
        assert np.frombuffer(table.encode(text), "<u4").tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0], repr(text)
    assert table.by_letters and table.by_parts and table.lowers
    assert codec.encode(None) == codec.encode("")


def best_fit_decreasing(lengths):
    free, count = [], 0
    for n in sorted(lengths.tolist(), reverse=True):
        k = bisect.bisect_left(free, n)
        room = free.pop(k) if k < len(free) else 2048
        count += room == 2048
        bisect.insort(free, room - n)
    return count


def test_packing_is_tight_and_gapless():
    rng = np.random.default_rng(7)
    for lengths in (rng.integers(1, 2049, 3000), rng.integers(1, 300, 500), np.full(50, 700), np.array([2048, 1]), np.array([], int)):
        sequence, place = packing.fill(lengths)
        count = len(set(sequence.tolist()))
        for s in set(sequence.tolist()):
            own = sorted(zip(place[sequence == s].tolist(), lengths[sequence == s].tolist()))
            assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 2048
        if len(lengths) > 400:
            assert count <= 1.01 * best_fit_decreasing(lengths) + 1
    assert len(set(packing.fill(np.full(50, 700))[0].tolist())) == 25


def test_markers_and_roles():
    assert chat.marker_of("User: hi") == (3, "hi") and chat.marker_of("### Assistant: x") == (4, "x")
    assert chat.marker_of("<|im_start|>system") == (2, "") and chat.marker_of("plain") == (0, "plain") and chat.marker_of("Note: x")[0] == 1
    model = chat.fit([])
    rnd = random.Random(8)
    lines = [rnd.choice(["User: a?", "Assistant: b.", "more text", "", "System: c"]) for _ in range(60)]
    whole = model.states("\n".join(lines), -1, -1)
    # Piecewise, as the distributed form does it, gives a path of the same score.
    chunks = ["\n".join(lines[k : k + 7]) for k in range(0, 60, 7)]
    first = model.start + model.emissions(chunks[0].split("\n"))[0]
    for row in model.emissions(chunks[0].split("\n"))[1:]:
        first = (first[:, None] + model.follow).max(axis=0) + row
    path = chat.borders([model.matrix(c) for c in chunks], first, -1, -1)
    pieced = [s for c, (before, after) in zip(chunks, path) for s in model.states(c, before, after)]

    def score(states):
        e = model.emissions(lines)
        return model.start[states[0]] + sum(e[k][s] for k, s in enumerate(states)) + sum(model.follow[a, b] for a, b in zip(states, states[1:]))

    assert abs(score(whole) - score(pieced)) < 1e-9


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1><a href="/">Home</a></header><nav><ul><li><a href=/a>A</a></li></ul></nav><div class="cookie-notice">We use cookies, as you know.</div>
<article><h1>Main &amp; title</h1><p>First   <b>bold</b> text,\nwith words.<p>Yes.</p><ul><li>one</li></ul><aside class="related">See also this long text.</aside>
<p>Last paragraph&nbsp;here.</p></article><section id="comments"><article class="comment"><p>Great text, thanks a lot for it.</p></article></section>
<form><label>Mail</label><button>Send</button></form><footer>&copy; us</footer></body></html>"""


def test_main_text_of_a_page():
    want = "Main & title\nFirst bold text, with words.\nYes.\none\nLast paragraph here."
    assert html_text.main_text(PAGE, html_text.PRIOR) == want
    plain = "<div><a href=1>Home</a></div><div><h1>Title here</h1><p>A long paragraph of plain text that goes on for a while, truly.</p></div>"
    assert html_text.main_text(plain, html_text.PRIOR) == "Title here\nA long paragraph of plain text that goes on for a while, truly."
    assert html_text.main_text(None, html_text.PRIOR) == html_text.main_text("", html_text.PRIOR) == html_text.main_text("<p", html_text.PRIOR) == ""


def test_blocks_of_broken_pages():
    def texts(page):
        return [b.text for b in html_text.blocks_of(page)[0]]

    assert texts("<p>a<b") == ["a<b"] and texts("a <!x <a") == ["a <!x <a"] and texts("<p>a<!-- b <c") == ["a"]
    assert texts("<p>a > b <a href='x") == ["a > b <a href='x"] and texts("<script>a") == [] and texts("<") == ["<"]
    assert texts("<a " * 300_000) == [("<a " * 300_000).strip()]  # in time that grows with the page
    blocks, _ = html_text.blocks_of("<h2><div>a</div></h2><li><p><i>b</i></p></li>c")
    assert [(b.text, b.heading, b.listed) for b in blocks] == [("a", True, False), ("b", False, True), ("c", False, False)]


def test_minimum_cut_against_all_labellings():
    rng = np.random.default_rng(9)
    for _ in range(40):
        n = 7
        costs = rng.normal(size=n)
        ties = [(int(a), int(b), float(rng.random())) for a, b in rng.integers(0, n, (9, 2)) if a != b]

        def price(side):
            return sum(-c if c < 0 and s else c if c > 0 and not s else 0 for c, s in zip(costs, side)) + sum(w for a, b, w in ties if side[a] != side[b])

        best = min(price([bool(k >> i & 1) for i in range(n)]) for k in range(2**n))
        assert abs(price(html_text.min_cut(costs, ties, n).tolist()) - best) < 1e-7


def test_base_secrets():
    text = 'é password=abc secret: "abcdef12" Token = token AKIA' + "A" * 16 + " " + "0af" * 8 + " api_key:x AKIAAKIA"
    base, _, _ = secret_scan.scan(text)
    want = []
    for kind, pattern, least in ((0, r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6), (1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        want += [(kind, *m.span()) for m in re.finditer(pattern, text) if len(m[m.lastindex or 0]) >= least]
    assert base == sorted(want, key=lambda s: (s[1], s[0])) and len(base) == 3
    assert secret_scan.scan(None)[:2] == ([], []) and secret_scan.digest([]) == secret_scan.digest([])


def test_random_strings_stand_out_from_words():
    rnd = random.Random(10)
    words = {(c, s): n for c in range(42) for s, n in ((60, 500),)}
    found = {}
    hidden = ["".join(rnd.choice(secret_scan.ALPHABETS["base64"]) for _ in range(44)) for _ in range(30)]
    for text in [*(f"x {h} y" for h in hidden), "x someVeryLongCamelCase1Identifier2OfWords3InARow4 y"]:
        for _, _, cell, step in secret_scan.scan(text)[1]:
            found[cell, step] = found.get((cell, step), 0) + 1
    steps = secret_scan.accepted_steps(found, words)
    hits = [secret_scan.scan(f"x {h} y")[1][0] for h in hidden]
    assert sum(s <= steps.get(c, -1) for _, _, c, s in hits) >= 25
    _, _, cell, step = secret_scan.scan("someVeryLongCamelCase1Identifier2OfWords3InARow4")[1][0]
    assert step > 8 and secret_scan.accepted_steps({}, {}) == {}
    assert secret_scan.encoding_of("4736962573099581") is None and secret_scan.encoding_of("abcdefghijklmnopq") is None


@pytest.mark.parametrize("text, want", [
    ("AWS_KEY=wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY", ["wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY"]),
    ("client_id=9fK2mQ8xT4bV7nZ1pR6w==", ["9fK2mQ8xT4bV7nZ1pR6w=="]),
    ("https://x.io/cb?sig=Zx81kQp0Lm3nBv7cXq2wEr5t&n=1", ["Zx81kQp0Lm3nBv7cXq2wEr5t"]),
    ("hooks.io/services/T00-a/B9x7Kq2mZ8vR4nT1pL6w", ["a/B9x7Kq2mZ8vR4nT1pL6w", "B9x7Kq2mZ8vR4nT1pL6w"]),
    ("é my-key_wJ4lrXUtnFEM/K7MDENG+bPxRfiC", ["wJ4lrXUtnFEM/K7MDENG+bPxRfiC"]),
])
def test_parts_of_runs_that_no_alphabet_holds_are_tested(text, want):
    found = [text[a:b] for a, b, _, _ in secret_scan.scan(text)[1]]
    assert set(want) <= set(found) and text not in found


def test_random_strings_without_a_digit_are_candidates_and_words_stay():
    text = "x kXqWzRvTbNmPlJhGfDsAyUiO MFRGGZDFMZTWQYLO kXq/WzRvTbNmPlJh+GfD internationalisation some-hyphenated-words 4736-9625-7309-9581 ---------------- y"
    rnd = random.Random(4)
    prose = " ".join("".join(rnd.choice("eeeetttaaooinnsshhrrdlu") for _ in range(6)) for _ in range(400_000))
    tested = {text[a:b]: (cell, step) for a, b, cell, step in secret_scan.scan(text)[1]}
    assert list(tested) == text.split()[1:6]
    assert secret_scan.scan("A" * 16 + " internationalisation")[2] == secret_scan.letter_stretches("A" * 16 + " internationalisation", secret_scan.SHORTEST)
    words = {}
    for k in range(64):
        for key, n in secret_scan.letter_stretches(prose[k * 30_000 :][:30_000]).items():
            words[key] = words.get(key, 0) + n
    found = {}
    strings = ["".join(rnd.choice(secret_scan.ALPHABETS["base64"][10:62]) for _ in range(40)) for _ in range(60)]
    for _, _, cell, step in [secret_scan.scan(x)[1][0] for x in strings] + list(map(lambda v: (0, 0, *v), tested.values())):
        found[cell, step] = found.get((cell, step), 0) + 1
    steps = secret_scan.accepted_steps(found, words)
    hits = [secret_scan.scan(x)[1][0] for x in strings]
    assert sum(step <= steps.get(cell, -1) for _, _, cell, step in hits) >= 30
    assert all(tested[w][1] > steps.get(tested[w][0], -1) for w in ("internationalisation", "some-hyphenated-words"))


def test_all_letters_of_a_text_are_counted_as_ordinary():
    rnd = random.Random(12)
    # Hex digits and code points outside ASCII are no letters; the text is longer than one slab of the test.
    text = " ".join("".join(rnd.choice("abcdeXYZé0") for _ in range(rnd.randint(1, 9))) for _ in range(90_000))
    letters, size = "".join(c for c in text if c.isascii() and c.isalpha()), 20 + zlib.crc32(text.encode()) % 60
    stretches = [letters[k : k + size] for k in range(0, len(letters) - size + 1, size)]
    assert len(stretches) > secret_scan.SLAB
    want = {}
    for run in stretches:
        for name, own in (("lower36", run.lower()), ("upper36", run.upper()), ("base32", run.upper()), ("base64", run), ("base64url", run)):
            key = secret_scan._cell(name, secret_scan.band_of(size)), secret_scan.step_of(own, name)
            want[key] = want.get(key, 0) + 1
    assert secret_scan.letter_stretches(text) == want and secret_scan.letter_stretches("a" * 19) == {}


def test_every_band_of_every_alphabet_is_compared_with_whole_texts():
    rnd = random.Random(5)
    words = {}
    for _ in range(300):
        text = " ".join("".join(rnd.choice("eeeetttaaooinnsshhrrdlu") for _ in range(6)) for _ in range(2_000))
        for key, n in secret_scan.scan(text)[2].items():
            words[key] = words.get(key, 0) + n
    counted = {c: sum(n for (cell, _), n in words.items() if cell == c) for c in range(len(secret_scan.NAMES) * len(secret_scan.BANDS))}
    compared = {secret_scan._cell(name, band) for name in secret_scan.NAMES for band in range(len(secret_scan.BANDS))}
    assert all(counted[c] >= 1000 for c in compared)
    _, _, cell, step = secret_scan.scan("Q7zK2m9XpL4t8Wv3")[1][0]
    assert secret_scan.accepted_steps({(cell, step): 1}, words)[cell] >= step


def test_a_table_of_words_stays_within_its_bounds():
    seen = []
    table = WordTable(lambda words: seen.extend(words) or [w[::-1] for w in words], bound=3, longest=4)
    for _ in range(2):
        assert table.lookup(["ab", "abcde", "ab", "cd"]) == ["ba", "edcba", "ba", "dc"]
    assert sorted(seen) == ["ab", "abcde", "abcde", "cd"] and set(table.known) == {"ab", "cd"}


def test_searches_find_what_brute_force_finds():
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(3000, 64))
    rotations = ann.learn_rotations(vectors[:1000], rounds=5)
    codes = ann.codes_of(vectors, rotations)
    shard = ann.Shard(codes)
    words = shard.words
    for q in range(5):
        found, radius = shard.within(codes[q], 200)
        apart = np.bitwise_count(words ^ words[q]).sum(axis=1)
        assert set(np.nonzero(apart <= radius)[0]) == set(found) and len(found) >= 200
    hits = ann.search_block(vectors, vectors[:60], rotations, 20)
    true = [np.argsort(-(vectors @ vectors[q]))[:20] for q in range(60)]
    assert np.mean([len(set(t) & set(f)) / 20 for t, (f, _) in zip(true, hits)]) >= 0.9


@pytest.mark.parametrize("dimension, spread", [(64, 0.0), (64, 0.5), (128, 0.3), (3, 0.2)])
def test_searches_of_full_shards_find_all_whatever_the_lengths(dimension, spread):
    rng = np.random.default_rng(13)
    vectors = rng.normal(size=(ann.SHARD, dimension))
    vectors *= rng.lognormal(sigma=spread, size=(ann.SHARD, 1)) / np.linalg.norm(vectors, axis=1, keepdims=True)
    for rotations in (ann.learn_rotations(ann.lifted(vectors[:1000]), rounds=5), ann.learn_rotations(vectors[:1000], rounds=5)):
        hits = ann.search_block(vectors, vectors[:40], rotations, 20, exact=True)
        for query, (rows, score) in zip(vectors, hits):
            exact = (vectors * query).sum(axis=1)
            assert set(rows) == set(np.argsort(-exact)[:20]) and (score == exact[rows]).all()


@pytest.mark.parametrize("dimension, spread", [(64, 0.0), (64, 0.2), (64, 0.3), (64, 0.5), (128, 0.0), (128, 0.3)])
def test_recall_of_full_shards(dimension, spread):
    rng = np.random.default_rng(15)
    vectors = rng.normal(size=(ann.SHARD, dimension))
    vectors *= rng.lognormal(sigma=spread, size=(ann.SHARD, 1)) / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = ann.search_block(vectors, vectors[:40], ann.learn_rotations(ann.lifted(vectors[:5000])), 20)
    true = [np.argsort(-(vectors @ vectors[q]))[:20] for q in range(40)]
    recall = np.mean([len(set(t) & set(f)) / 20 for t, (f, _) in zip(true, hits)])
    print(dimension, spread, recall)
    assert recall >= 0.9


def test_probing_of_close_codes_gives_the_same_rows_as_comparing_all():
    rng = np.random.default_rng(16)
    centres = rng.normal(size=(40, 64))
    vectors = np.repeat(centres, 100, axis=0) + 0.01 * rng.normal(size=(4000, 64))
    codes = ann.codes_of(vectors, ann.learn_rotations(vectors[:500], rounds=3))
    shard = ann.Shard(codes)
    for q in range(0, 4000, 97):
        found, radius = shard.within(codes[q], 60)
        apart = np.bitwise_count(shard.words ^ shard.words[q]).sum(axis=1)
        assert radius < 64 and set(found) == set(np.nonzero(apart <= radius)[0]) and len(found) >= 60


def test_bounds_hold_for_vectors_of_which_more_bits_differ():
    rng = np.random.default_rng(14)
    for dimension in (3, 10, 64, 300):
        vectors, queries = rng.normal(size=(2000, dimension)), rng.normal(size=(20, dimension))
        rotations = ann.learn_rotations(vectors, rounds=2)
        shard, bounds = ann.Shard(ann.codes_of(vectors, rotations)), ann.bounds_of(queries, rotations)
        cosines = (queries @ vectors.T) / np.linalg.norm(vectors, axis=1) / np.linalg.norm(queries, axis=1)[:, None]
        for k, code in enumerate(ann.codes_of(queries, rotations)):
            for radius in (10, 60, 120):
                outside = np.setdiff1d(np.arange(len(vectors)), shard.inside(code, radius))
                assert (cosines[k, outside] <= bounds[k, radius]).all()


def test_licence_classifier():
    model = license_scan.fit(["Plain prose about cats.", "Another paragraph."])
    probabilities = model.probabilities(["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "the cat sat on a mat",
                                         "This work is licensed under the Foobar Community License"])
    best = [model.classes[k] for k in probabilities.argmax(axis=1)]
    assert best == ["Apache-2.0", "MIT", "none", "unknown"]
