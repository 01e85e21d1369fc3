"""Lines, mixing, quality rules and languages on small tables, by plain Python."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from retinue.llm import language, lines, mixing, quality
from retinue.llm.defaults import language_model

# Columns of the input may have the names that the operators use themselves.
TABLE = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, body string, key string, "
    "kept string, size int, n_words int, x string, team string, score string"
)


def table(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 9) for r in rows], TABLE)


ODD = [
    (1, "first line here\nSecond line here\n\nshort", "en", "a", 1),
    (2, "  FIRST LINE HERE\t\nother words\nother words", "en", "a", 1),
    (3, "second line here", "en", None, 1),
    (4, None, None, None, None),
    (5, "", "fr", "b", 0),
    (6, "\n\n", "fr", "b", 2),
    (6, "\n\n", "fr", "b", 2),
    (7, "short\nsecond line here\nÀ LINE OF ITS OWN", "fr", "", 1),
    (7, "another text of seven\nfirst line here", "fr", "", 1),
    (8, "à line of its own", "fr", "B", 1),
    (None, "first line here\nnobody has this line", "en", "a", 1),
    (9, "long line " * 20_000 + "\n" + "x\n" * 20_000 + "Other words", "en", "a", 1),
    (10, "one two three one two three one two three #*$", "en", "c", 1),
]


def key(line):
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def plain_lines(rows):
    holders = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(math.inf if r[0] is None else r[0])
    out = []
    for r in rows:
        own = math.inf if r[0] is None else r[0]
        whole = (r[1] or "").split("\n")
        left = [x for x in whole if len(holders[key(x)]) < 2 or min(holders[key(x)]) == own]
        out.append((r[0], len(whole), len(whole) - len(left), "\n".join(left)))
    return Counter(out)


def test_lines_by_brute_force(spark):
    got = lines.drop_repeated_lines(table(spark, ODD)).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == plain_lines(ODD)
    assert Counter((r.row.doc_id, r.row.text) for r in got) == Counter((r[0], r[1]) for r in ODD)
    assert lines.drop_repeated_lines(table(spark, [])).count() == 0


def test_lines_need_as_many_documents_as_asked(spark):
    rows = [(i, f"a shared line\n{'in three of them' if i < 3 else 'own line ' + str(i)}", *[None] * 3) for i in range(5)]
    got = {r.doc_id: r.n_dropped for r in lines.drop_repeated_lines(table(spark, rows), min_docs=4).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1}


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, cut at the limits and share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        pool = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * weight[s] > most * sizes[s] * pool}
        if not over:
            return {s: most * sizes[s] if s in full else rest * weight[s] / pool if pool else 0.0 for s in names}
        full |= over


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_by_brute_force(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 7, 50, 1000, 40000]) for i in range(rng.randint(1, 30))} | {None: 20}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix_of_odd_rows_and_its_rows(spark):
    docs = table(spark, ODD)
    got = mixing.repeats(docs).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter(
        (r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in ODD
    )
    for r in got:
        rate = r.target / r.source_size if r.source_size else 0
        assert math.floor(rate) <= r.copies <= min(3, math.floor(rate) + 1)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert sorted(map(str, mixing.repeats(docs).collect())) == sorted(map(str, got))
    assert mixing.repeats(table(spark, [])).count() == 0


def test_taken_words_come_near_their_target(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(1, 60), None, rng.choice("aabcdefg"), 1) for i in range(8000)]
    by = defaultdict(int)
    for r in (got := mixing.repeats(table(spark, rows)).collect()):
        by[r.target, r.row.source] += r["size"] * r.copies
    assert len(got) == 8000
    for (target, _), taken in by.items():
        assert taken == pytest.approx(target, rel=0.08)


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, repeated, len(covered)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics_by_brute_force(spark):
    rng = random.Random(4)
    texts = [r[1] for r in ODD] + ["a a a", "a a a a", "a b\x0bc\x0cd\re", "  \n a\n a\n\n", "a b c x a b c a b c"]
    texts += ["".join(rng.choices("ab #\n\té", k=rng.randint(0, 60))) for _ in range(300)]
    docs = table(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in quality.statistics(docs).collect()}
    assert got == {i: plain_statistics(t) for i, t in enumerate(texts)}


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, prose(rng.randint(60, 300)), rng.choice(["en", None]), "s", 1) for i in range(600)]
    rows += [(1000 + i, " ".join(word() + "###" for _ in range(100)), "en", "s", 1) for i in range(30)]
    rows += [(2000 + i, prose(10), "en", "s", 1) for i in range(20)]
    rows += [(3000 + i, prose(100), "de", f"rare{i}", 1) for i in range(20)] + [(4000, None, None, None, None)]
    got = {r.doc_id: r for r in quality.judge(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert all(r.kept for i, r in got.items() if i < 1000 or 3000 <= i < 4000)
    assert not any(r.kept for i, r in got.items() if 1000 <= i < 3000 or i == 4000)
    assert all(r.base_failed for i, r in got.items() if 2000 <= i < 3000 or i == 4000)
    assert quality.judge(table(spark, [])).count() == 0


def test_each_statistic_alone_rejects_below_the_base_limit(spark):
    rng = random.Random(8)
    word = lambda n=6: "".join(rng.choices("abcdefghijklmnop", k=n))
    prose = lambda n, size=6: [word(size + rng.choice([-1, 0, 1])) for _ in range(n)]
    rows = [(i, " ".join(prose(rng.randint(150, 300))), "en", "s", 1) for i in range(300)]
    # A third of the words in repeated windows, 4 % symbols, five repeated lines, longer words.
    half = prose(40)
    odd = {
        1000: " ".join(prose(80) + half + prose(80) + half),
        1001: " ".join(prose(100) + ["#" + w for w in prose(50)] + prose(50)),
        1002: "\n".join(" ".join(prose(30)) + ("\nsix" if i else "") for i in range(7)),
        1003: " ".join(prose(200, 8)),
    }
    rows += [(i, t, "en", "s", 1) for i, t in odd.items()]
    got = {r.doc_id: r for r in quality.judge(table(spark, rows)).collect()}
    assert all(got[i].kept for i in range(300))
    assert not any(got[i].base_failed for i in odd)
    assert [i for i in odd if got[i].kept] == []
    assert got[1000].n_symbols == got[1000].n_dup_lines == 0 and got[1000].n_repeat_words == 80
    assert got[1001].n_dup_lines == got[1001].n_repeat_words == 0 and got[1001].n_symbols == 50
    assert got[1002].n_symbols == got[1002].n_repeat_words == 0 and got[1002].n_dup_lines == 5
    assert got[1003].n_symbols == got[1003].n_repeat_words == got[1003].n_dup_lines == 0


def test_estimates_withstand_outliers(spark):
    rng = np.random.default_rng(2)
    x = rng.multivariate_normal([1, 2], [[1, 0.6], [0.6, 2]], 4000)
    x[:200] = rng.normal(30, 1, (200, 2))
    frame = spark.createDataFrame([("t", v.tolist()) for v in x], "team string, x array<double>")
    r = quality.mcd(frame, floors=(1e-6, 1e-6)).first()
    assert r["mean"] == pytest.approx([1, 2], abs=0.15)
    w = np.array([[r.factor[0], 0], [r.factor[1], r.factor[2]]])
    # The central three quarters of all are a slightly wider share of the good ones.
    assert np.linalg.inv(w.T @ w) == pytest.approx(np.array([[1, 0.6], [0.6, 2]]), abs=0.35)


def plain_estimate(x, floors, support=0.75, steps=3):
    """Centre and covariance by the steps of ``quality.mcd``, in plain numpy."""
    ranked = lambda values, share: np.sort(values)[max(0, math.ceil(share * len(values)) - 1)]
    floor = np.diag(np.square(floors))
    centre = np.array([ranked(c, 0.5) for c in x.T])
    spread = np.array([1.4826 * ranked(abs(c - m), 0.5) for c, m in zip(x.T, centre)])
    best = None
    for mean, cov in ((centre, np.diag(spread**2)), (x.mean(axis=0), np.cov(x.T, bias=True))):
        for _ in range(steps):
            away = x - mean
            d = np.einsum("ni,ij,nj->n", away, np.linalg.inv(cov + floor), away)
            inside = x[d <= ranked(d, support)]
            mean, cov = inside.mean(axis=0), np.cov(inside.T, bias=True)
        det = np.linalg.slogdet(cov + floor)[1]
        if best is None or det < best[0] - 1e-9:
            best = det, mean, cov
    dims = len(floors)
    shrunk = quality.chi_square_cdf(quality.chi_square_quantile(support, dims), dims + 2) / support
    return best[1], best[2] / shrunk + floor


def test_distances_and_verdicts_by_plain_steps(spark):
    rng = random.Random(31)

    def text():
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(rng.randint(55, 140))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            words[rng.randrange(len(words))] += "#" * rng.randint(1, 4)
        at = rng.randrange(len(words) - 12)
        words += words[at : at + rng.choice([0, 3, 5, 12])]
        return " ".join(words) + "\nsame line" * rng.choice([0, 0, 1, 2, 6])

    teams = [("en", "web", 250), ("en", None, 130), (None, "web", 110)]  # teams of their own
    teams += [("de", "a", 60), ("de", None, 70), ("fr", "b", 30), ("it", "c", 20)]  # pooled, and too few for it
    rows = [(text(), lang, source) for lang, source, n in teams for _ in range(n)]
    odd = " ".join(f"#$#$x{i}" for i in range(90))  # passes the base rules
    rows += [(odd + f" z{i}", lang, source) for i, (lang, source, _) in enumerate(teams)]
    rows += [("few words", "en", "web"), (None, "en", None), ("one two three " * 40, "de", "a")]
    rows = [(i, t, lang, source, None) for i, (t, lang, source) in enumerate(rows)]
    got = {r.doc_id: r for r in quality.judge(table(spark, rows)).collect()}
    assert sorted(got) == [r[0] for r in rows]
    own, points = {}, defaultdict(list)
    sizes = Counter((r.lang, r.source) for r in got.values() if not r.base_failed)
    for i, r in got.items():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        if r.base_failed:
            continue
        chars = max(1, r.word_chars)
        x = [math.log(chars / r.n_words), math.sqrt(r.n_symbols / chars)]
        x += [math.log1p(r.n_dup_lines), math.sqrt(r.n_repeat_words / r.n_words)]
        pool = sum(n for (lang, _), n in sizes.items() if lang == r.lang and n < 100)
        team = (r.lang, r.source) if sizes[r.lang, r.source] >= 100 else (r.lang,) if pool >= 100 else ()
        own[i] = team, np.array(x)
        points[team].append(x)
    assert {len(t): len(points[t]) >= 100 for t in points} == {2: True, 1: True, 0: False}
    models = {t: plain_estimate(np.array(x), quality.FLOORS) for t, x in points.items() if len(x) >= 100}
    cut = quality.chi_square_quantile(1 - 1e-7, 4)
    for i, r in got.items():
        team, x = own.get(i, (None, None))
        if team not in models:
            assert r.distance is None and r.kept == (not r.base_failed)
            continue
        mean, cov = models[team]
        want = (x - mean) @ np.linalg.solve(cov, x - mean)
        assert r.distance == pytest.approx(want, rel=1e-6)
        assert r.kept == (want <= cut)
    assert {r.kept for i, r in got.items() if own.get(i, (None,))[0] in models} == {True, False}


def test_chi_square():
    assert quality.chi_square_quantile(0.95, 4) == pytest.approx(9.48773, abs=1e-4)
    assert quality.chi_square_quantile(0.975, 2) == pytest.approx(7.37776, abs=1e-4)


def test_forward_sums_all_segmentations():
    import public_tokenizers

    vocabulary = language.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(1)
    chances = rng.dirichlet(np.ones(vocabulary.size), 2).T
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    pieces = {processor.id_to_piece(i): i for i in range(vocabulary.size) if not processor.is_byte(i)}

    def total(word, column):
        if not word:
            return 1.0
        out = 0.0
        for n in range(1, len(word) + 1):
            if word[:n] in pieces:
                out += chances[pieces[word[:n]], column] * total(word[n:], column)
            elif n == 1:
                own = np.prod([chances[vocabulary.bytes[b], column] for b in word[0].encode()])
                out += own * total(word[1:], column)
        return out

    words = ["▁the", "▁a", "▁und", "▁çaïx", "▁ꙮa"]
    got = language.log_chances(words, vocabulary, chances)
    for i, word in enumerate(words):
        for column in range(2):
            assert got[i, column] == pytest.approx(math.log(total(word, column)))
    counts = language.expected_counts(words, np.ones(5), vocabulary, chances[:, 0])
    # The pieces of all segmentations of a word cover each of its letters once.
    spell = {i: p for p, i in pieces.items()}
    covered = sum(counts[i] * len(spell[i]) for i in np.flatnonzero(counts) if i in spell)
    assert covered == pytest.approx(sum(map(len, words)) - 1)


def outside(vocabulary, first, n):
    """Letters that only bytes can spell."""
    letters = [chr(c) for c in range(first, first + 4000) if chr(c).isalpha() and not vocabulary._letters[c]]
    return "".join(letters[:n])


def test_long_words_of_letters_outside_the_vocabulary():
    import public_tokenizers

    vocabulary = language.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(2)
    even = np.full((vocabulary.size, 1), 1 / vocabulary.size)
    for chances in (even, rng.dirichlet(np.ones(vocabulary.size), 2).T):
        start = np.log(chances[vocabulary.edges(["▁"])[0][0, 1, 1]])
        # Chinese, Ethiopic and mathematical letters: three and four bytes each.
        for first in (0x4E00, 0x1200, 0x1D400):
            word = outside(vocabulary, first, 32)
            assert len(word) == 32
            numbers = vocabulary.bytes[list(word.encode())]
            got = language.log_chances(["▁" + word, "▁the"], vocabulary, chances)
            assert got[0] == pytest.approx(start + np.log(chances[numbers]).sum(axis=0))
            assert np.isfinite(got[1]).all()
            counts = language.expected_counts(["▁" + word, "▁the"], np.array([3.0, 1.0]), vocabulary, chances[:, 0])
            assert counts[np.unique(numbers)].sum() == pytest.approx(3 * len(numbers))
    # Where both ways can say a word, they say the same.
    words = ["▁the", "▁und", "▁çaïx", "▁ꙮa", "▁international"]
    found, lengths, extra = vocabulary.edges(words)
    table = vocabulary.extended(chances, extra)
    plain = language._forward(found, table)[np.arange(5), lengths]
    logs = language._log_forward(found, np.log(np.maximum(table, 1e-320)))[np.arange(5), lengths]
    assert logs == pytest.approx(np.log(plain))


def test_letters_outside_the_vocabulary_in_training_and_prediction(spark):
    import public_tokenizers

    vocabulary = language.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    chinese, mathematical = outside(vocabulary, 0x4E00, 32), outside(vocabulary, 0x1D400, 32)
    rows = [(i, "the and of to in is that", "en", "s", 1) for i in range(8)]
    rows += [(i, "der die und das ist nicht", "de", "s", 1) for i in range(8, 16)]
    rows += [(16, f"the {chinese} and", "en", "s", 1), (17, f"und {mathematical}", "de", "s", 1)]
    rows += [(18, f"das ist {outside(vocabulary, 0x1200, 32)}", None, "s", 1)]
    docs = table(spark, rows)
    model = language.fit(docs, path=public_tokenizers.path("piece_bpe_32k.model"))
    assert np.isfinite(model.chances).all()
    got = {r.doc_id: r for r in language.predict(docs, model, doc_id="doc_id").collect()}
    assert all(got[i].lang_pred == "en" for i in [*range(8), 16])
    assert [got[i].lang_pred for i in [*range(8, 16), 17]] == ["de"] * 9
    assert got[18].lang_pred in ("en", "de")
    assert all(0 <= r.score <= 1 for r in got.values())


def test_sums_of_texts_hold_few_words_at_a_time(monkeypatch):
    draw = np.random.default_rng(5)
    logs = draw.normal(size=(50, 10))
    bounds = np.concatenate([[0], np.cumsum(draw.integers(1, 400, 5000))])
    indices = draw.integers(0, 50, bounds[-1])
    want = np.add.reduceat(logs[indices], bounds[:-1], axis=0)
    tracemalloc.start()
    got = language._sums(logs, indices, bounds)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == want).all() and peak < 10 * 8 * len(indices) / 3
    # Texts longer than what is held, and a few words at a time.
    monkeypatch.setattr(language, "SUMMED", 7)
    assert (language._sums(logs, indices[: bounds[30]], bounds[:31]) == want[:30]).all()


def test_languages_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from retinue.llm.queries import QUERIES

    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(truth)
    import zlib

    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_of_odd_rows(spark):
    rows = [(i, "the and of to in is that", "en", "s", 1) for i in range(8)]
    rows += [(i, "der die und das ist nicht", "de", "s", 1) for i in range(8, 16)]
    rows += [(20, None, "en", "s", 1), (21, "", None, None, None), (22, "123 !?", "de", "s", 1)]
    rows += [(None, "the that", None, "s", 1), (23, "und" * 5000 + " das ist", None, "s", 1), (23, "DER DIE", "en", "s", 1)]
    docs = table(spark, rows)
    keep = {"doc_id": "doc_id", "row": "row"}
    got = Counter((r.doc_id, r.lang_pred) for r in language.predict(docs, language_model(docs), **keep).collect())
    assert got[20, "und"] == got[21, "und"] == got[22, "und"] == 1
    assert got[None, "en"] == 1 and got[23, "de"] == 2
    none = language.predict(docs, language_model(docs.where("lang = 'xx'")), doc_id="doc_id").collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert language.predict(docs.limit(0), language_model(docs), doc_id="doc_id").count() == 0


def test_a_digest(spark):
    kept = lines.drop_repeated_lines(table(spark, ODD[:2])).selectExpr("doc_id", "sha2(kept, 256) AS h")
    assert {r.doc_id: r.h for r in kept.collect()}[2] == hashlib.sha256(b"other words\nother words").hexdigest()
