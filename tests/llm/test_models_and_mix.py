"""Toxicity chain, quality trees, mixing and decontamination on small tables."""

import edge_cases
import numpy as np
import pyarrow as pa
import pytest

import brute
from lapse.llm import decontaminate, mixing, quality, toxicity
from lapse.llm.sampling import fold_of, labelled_sample

SF = "/root/testdata/sf0.01"
ROWS = edge_cases.edge_rows()


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark")}


def test_toxicity_catches_labelled_words_and_spares_clean_texts(spark, tables, edge, clashing, empty):
    train = tables["labels"].where(fold_of("doc_id", 3) != 1)
    chain = toxicity.train(tables["documents"], train)
    assert chain.names == ["insult", "contempt", "toxic"]
    assert [len(w) for w in chain.weights] == [len(chain.vocabulary) + 1 + i for i in range(3)]
    held = toxicity.score(tables["documents"], chain).join(tables["labels"].where(fold_of("doc_id", 3) == 1).withColumnRenamed("toxic", "is"), "doc_id")
    seeds = "idiot|moron|scum|loser|stupid|trash|clown|pathetic|worthless|disgusting"
    rows = held.join(tables["documents"].select("doc_id", "text"), "doc_id").collect()
    named = [r for r in rows if r["is"] and any(s in r["text"].lower() for s in seeds.split("|"))]
    assert named and sum(r["toxic"] for r in named) >= 0.9 * len(named)
    clean = [r for r in rows if not r["is"]]
    assert sum(r["toxic"] for r in clean) <= 0.02 * len(clean)
    scored = toxicity.score(clashing, chain)
    assert scored.columns == ["doc_id", "p_insult", "p_contempt", "p_toxic", "toxic"] and scored.count() == len(ROWS)
    assert toxicity.drop_toxic(clashing, chain).columns == clashing.columns
    assert toxicity.score(empty, chain).count() == toxicity.drop_toxic(empty, chain).count() == 0
    assert toxicity.score(edge, toxicity.train(edge, tables["labels"].limit(0))).where("toxic").count() == 0


def test_chain_feeds_earlier_probabilities_forward():
    r = np.random.default_rng(0)
    x = (r.random((400, 6)) < 0.3).astype(float)
    y = np.column_stack([x[:, 0], x[:, 1], np.maximum(x[:, 0], x[:, 1])])
    chain = toxicity.fit_chain(["a", "b", "any"], np.arange(6, dtype=np.uint64), x, y, np.arange(400) % 5)
    assert chain.weights[2][6] > 0 and chain.weights[2][7] > 0


def test_sample_is_bounded_and_repeatable(spark, tables):
    one, two = (sorted(r.doc_id for r in labelled_sample(tables["documents"], tables["labels"], ["toxic"], max_rows=50).collect()) for _ in range(2))
    assert one == two and len(one) == 50


def test_quality_on_held_out_rows(spark, tables, edge, clashing, empty):
    trees = quality.train(tables["documents"], tables["labels"].where(fold_of("doc_id", 3) != 1))
    rows = quality.score(tables["documents"], trees).join(tables["labels"].where(fold_of("doc_id", 3) == 1), "doc_id").collect()
    assert rows and sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
    got = quality.score(clashing, trees).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert quality.score(empty, trees).count() == 0
    none = quality.train(edge, tables["labels"].limit(0))
    assert {round(r.score, 6) for r in quality.score(edge, none).collect()} == {0.5}


def test_trees_match_a_walk_node_by_node():
    r = np.random.default_rng(1)
    x = r.random((300, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    trees = quality.fit_trees(x, y, trees=30)
    slow = []
    for row in x:
        total = trees.bias
        for split, above, leaf in zip(trees.split, trees.above, trees.leaf):
            node = 0
            while node < len(split):
                node = 2 * node + 1 + int(row[split[node]] > above[node])
            total += leaf[node - len(split)]
        slow.append(1 / (1 + np.exp(-total)))
    assert np.allclose(trees.score(x), slow) and ((trees.score(x) > 0.5) == y).mean() > 0.95


def test_statistics_do_not_depend_on_the_batch():
    texts = [t for _, t, *_ in ROWS]
    alone = np.vstack([quality.statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(quality.statistics(pa.array(texts, pa.string())), alone)


def water_fill(sizes, weights=(5, 2, 1), cap=3):
    """Targets by literal resharing: capped sources leave, the rest share what is left."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        left = sum(sizes.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            open_.discard(s)
    return target


def test_mixing_targets_and_copies(spark, clashing, empty):
    rows = [(i, edge_cases.prose(i, 5 + i * 7 % 90), f"s{i % 9 if i % 9 < 7 else 0}" if i % 11 else None) for i in range(900)]
    rows += [(2000 + i, "tiny text", "small") for i in range(3)] + [(3000, None, "void"), (3001, "", "void")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want = water_fill(sizes)
    taken = {}
    for r in got:
        assert r.size == len(brute.words(dict((a, b) for a, b, _ in rows)[r.doc_id])) and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= max(100, 0.02 * want[s]) for s in want)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(3)).collect()))
    assert mixing.mix(clashing).count() == len(ROWS) and mixing.mix(empty).count() == 0


def test_rates_are_exponential_tilts(spark):
    rows = [(i, edge_cases.prose(i, 10 + i % 50), "ab"[i % 2]) for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for s in "ab":
        slopes = {round(float(np.log(r.rate)) / r.size, 9) for r in got if r.source == s and r.rate < 2.999}
        assert len(slopes) <= 1
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.rate * r.size for r in mine) - mine[0].target) < 1e-5 * mine[0].target


def leaky(spark):
    items = [(n, edge_cases.prose(500 + n, 30).capitalize() + "? " + edge_cases.prose(700 + n, 5) + ".") for n in range(30)] + [(98, None), (99, "...")]
    rows = [(i, edge_cases.prose(i, 40 + i % 300)) for i in range(300)]
    want = set()
    for n in range(30):
        w = items[n][1].split()
        if n % 3 == 1:  # a paraphrase: every sixth word is another
            w = [x if k % 6 else f"other{k}" for k, x in enumerate(w)]
        if n % 3 == 2:  # other case and punctuation
            w = [x.upper() + "," for x in w]
        text = rows[n * 7][1].split()
        rows[n * 7] = (n * 7, " ".join(text[:n] + w + text[n:]))
        want.add((n * 7, n))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), want


def test_leaks_and_paraphrases_are_found(spark, clashing, empty, monkeypatch):
    docs, items, want = leaky(spark)
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
    assert got == want
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 7)  # the same in several blocks
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()} == want
    assert decontaminate.drop_leaks(docs, items).count() == docs.count() - len(want)
    assert decontaminate.find_leaks(empty, items).count() == decontaminate.find_leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.drop_leaks(clashing, items).columns == clashing.columns


def test_decontamination_recall_on_the_given_tables(spark, tables):
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(tables["documents"], tables["benchmark"]).collect()}
    items = {r.item_id: " ".join(brute.words(r.text)) for r in tables["benchmark"].collect()}
    exact = {(r.doc_id, i) for r in tables["documents"].collect() for i, t in items.items() if t in " ".join(brute.words(r.text))}
    assert exact and len(exact & found) >= 0.9 * len(exact)
    assert len(found - exact) <= 0.1 * len(found)


def test_short_items_are_found_whatever_the_number_of_documents(spark, monkeypatch):
    given = {n: spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "benchmark")}
    items = [(r.item_id, r.text) for r in given["benchmark"].collect() if len(brute.words(r.text)) < 20]
    strange = [" ".join(f"strange{i}x{k}" for k in range(30)) for i in range(2 * len(items))]
    rows = [(n, f"{strange[2 * k]} {t} {strange[2 * k + 1]}") for k, (n, t) in enumerate(items)]
    docs, short = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    count = decontaminate._frequencies
    for times in (1, 10 ** 5):  # the given documents, and as many more in proportion
        def scaled(texts, block, times=times):
            held, n = count(given["documents"], block)
            return held * times, n * times
        monkeypatch.setattr(decontaminate, "_frequencies", scaled)
        got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, short).collect()}
        assert items and {(n, n) for n, _ in items} <= got


def test_lcs_bits_match_the_table():
    r = np.random.default_rng(3)
    for _ in range(50):
        a, b = r.integers(0, 6, 20), r.integers(0, 6, 30)
        t = np.zeros((21, 31), int)
        for i in range(20):
            for j in range(30):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert decontaminate.lcs_length(decontaminate.place_bits(a), 20, b.tolist()) == t[20, 30]


def test_leaks_of_rows_without_an_id_leave_the_others(spark):
    docs, items, want = leaky(spark)
    nameless = docs.selectExpr("cast(null as long) as doc_id", "text")
    assert decontaminate.drop_leaks(nameless, items).count() == docs.count() - len(want)


def brute_leaks(rows, items):
    """Every passage against every item: the longest common subsequences alone decide."""
    found = set()
    for doc, text in rows:
        code = decontaminate.tokens(pa.array([text], pa.string())).hash
        for item, words in items:
            own = decontaminate.tokens(pa.array([words], pa.string())).hash
            answer = decontaminate.tokens(pa.array([decontaminate.answer_of(words)], pa.string())).hash
            n, m = len(own), max(len(answer), 1)
            reach = n // 2 + decontaminate.STRIDE
            for at in decontaminate.windows(np.array([0, len(code)]))[0].tolist() if n else []:
                near = code[max(0, at - reach):at + max(decontaminate.WINDOW, n) + reach].tolist()
                share = decontaminate.lcs_length(decontaminate.place_bits(own), n, near) / n
                if share >= decontaminate.MIN_LCS and (share >= decontaminate.SURE or decontaminate.lcs_length(
                        decontaminate.place_bits(answer), len(answer), near) / m >= decontaminate.MIN_ANSWER):
                    found.add((doc, item))
                    break
    return found


def test_leaks_against_every_passage_and_item(spark, tables):
    import random
    r = random.Random(8)
    items = [(x.item_id, x.text) for x in tables["benchmark"].orderBy("item_id").limit(24).collect()]
    rows = [(x.doc_id, x.text or "") for x in tables["documents"].orderBy("doc_id").limit(40).collect()]
    for k, (item, words) in enumerate(items):  # paraphrases of every strength: words replaced, left out, put in, moved
        w = words.split()
        for _ in range(int(len(w) * (k % 8) / 14)):
            at = r.randrange(len(w))
            w[at:at + r.randint(0, 1)] = [f"w{r.randint(0, 999)}"] * r.randint(0, 1)
            if r.random() < 0.2 and len(w) > 3:
                a = r.randrange(len(w) - 1)
                w[a], w[a + 1] = w[a + 1], w[a]
        host = rows[k][1].split() or ["empty"]
        at = r.randrange(len(host))
        rows.append((100_000 + item, " ".join(host[:at][-200:] + w + host[at:][:200])))
    want = brute_leaks(rows, items)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert 10 < len(want) < len(items) * 2 and got <= want
    assert len(got) >= 0.95 * len(want)  # the latent space leaves a close call out now and then


def test_fit_sample_is_bounded_and_repeatable(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_FIT_DOCS", 20)
    rows = [(None, f"text {i % 7}") for i in range(500)] + [(i, f"text {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, two = (sorted(x.text for x in decontaminate._fit_sample(d).collect()) for d in (df, df.repartition(5)))
    assert one == two and 0 < len(one) <= 20
    assert decontaminate._fit_sample(df.limit(0)).count() == 0


def test_latent_space_is_fitted_on_every_document(spark, monkeypatch):
    docs, items, want = leaky(spark)
    texts = docs.selectExpr("doc_id", "coalesce(text, '') as text")
    block = next(decontaminate.item_blocks(items, "item_id", "text"))
    held, n = decontaminate._frequencies(texts, block)
    block.idf = np.log((n + 2.0) / (held + 1.0))
    dense = np.random.default_rng(5).standard_normal((len(block.vocabulary), 6))
    own = np.zeros(len(block.vocabulary))
    whole = np.zeros((len(own), len(own)))
    codes = [decontaminate.tokens(pa.array([r.text], pa.string())).hash for r in texts.collect()] + block.codes
    for code in codes:
        place = decontaminate.lookup(block.vocabulary, code)
        for a, b in zip(*decontaminate.windows(np.array([0, len(code)]))):
            row = np.bincount(place[a:b][place[a:b] >= 0], minlength=len(own)) * block.idf
            whole += np.outer(row, row)
    assert np.allclose(decontaminate._gram_product(texts, block, dense), whole @ dense)
    monkeypatch.setattr(decontaminate, "MAX_FIT_DOCS", 1)
    monkeypatch.setattr(decontaminate, "_fit_sample", lambda texts: (_ for _ in ()).throw(AssertionError("the fit reads a sample")))
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()} == want
    assert decontaminate.drop_leaks(docs, items).count() == docs.count() - len(want)


def test_fit_reads_the_texts_once(spark):
    docs, items, _ = leaky(spark)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    texts = docs.selectExpr("doc_id", "coalesce(text, '') as text").mapInArrow(seen, "doc_id long, text string")
    block = decontaminate.fit_block(texts, next(decontaminate.item_blocks(items, "item_id", "text")))
    assert read.value == docs.count() and block.basis.shape[0] == len(block.vocabulary)


@pytest.mark.parametrize("most", [decontaminate.PAIRS, 50])  # 50: what tasks hold is handed on in many pieces
def test_pair_counts_against_every_passage(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "PAIRS", most)
    monkeypatch.setattr(decontaminate, "PIECE", 7 if most == 50 else decontaminate.PIECE)
    rows = [(i, edge_cases.prose(i % 9, n)) for i, n in enumerate([0, 1, 2, 23, 24, 25, 31, 32, 33, 40, 41, 150, 700])] + [(None, "x"), (1, "x x x x")]
    items = spark.createDataFrame([(1, edge_cases.prose(1, 60)), (2, "x is an answer"), (3, edge_cases.prose(5, 30))], "item_id long, text string")
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    block = next(decontaminate.item_blocks(items, "item_id", "text"))
    size, want = len(block.vocabulary), {}
    for _, text in rows:
        code = decontaminate.tokens(pa.array([text], pa.string())).hash
        place = decontaminate.lookup(block.vocabulary, code)
        for w in {*place.tolist()} - {-1}:
            want[-1 - w] = want.get(-1 - w, 0) + 1
        for a, b in zip(*decontaminate.windows(np.array([0, len(code)]))):
            held = np.bincount(place[a:b][place[a:b] >= 0], minlength=size)
            for i in np.flatnonzero(held).tolist():
                for j in np.flatnonzero(held[i:]).tolist():
                    want[i * size + i + j] = want.get(i * size + i + j, 0) + int(held[i] * held[i + j])
    want[-1 - size] = len(rows)
    got = decontaminate._pair_counts(texts, block).collect()
    assert {r.pair: r.n for r in got} == want and len(got) == len(want)


def test_codes_that_share_their_first_bits_are_told_apart():
    r = np.random.default_rng(4)
    code = np.concatenate([r.integers(0, 2 ** 63, 300, dtype=np.uint64) * np.uint64(2), np.uint64(7) + np.arange(40, dtype=np.uint64), ~np.arange(40, dtype=np.uint64)])
    vocabulary = np.unique(code[::3])
    at = {c: i for i, c in enumerate(vocabulary.tolist())}
    assert decontaminate.lookup(vocabulary, code).tolist() == [at.get(c, -1) for c in code.tolist()]


def test_candidates_do_not_depend_on_how_words_are_met(spark, tables, monkeypatch):
    items = tables["benchmark"].orderBy("item_id").limit(24)
    docs = tables["documents"].orderBy("doc_id").limit(60)
    block = decontaminate.fit_block(docs.selectExpr("doc_id", "coalesce(text, '') as text"), next(decontaminate.item_blocks(items, "item_id", "text")))
    words = decontaminate.tokens(pa.array([r.text for r in docs.collect()] + [r.text for r in items.collect()], pa.string()))
    found = []
    for common in (0, 5, decontaminate.COMMON, 10 ** 6):
        monkeypatch.setattr(decontaminate, "COMMON", common)
        found.append(decontaminate.candidates(words, block, 0.1))
    assert len(found[0][0]) >= 24
    for other in found[1:]:
        assert all(np.array_equal(a, b) for a, b in zip(found[0][:2], other[:2])) and np.allclose(found[0][2], other[2])


def test_small_sources_come_within_a_word_or_two_of_their_target(spark, tables):
    got = mixing.mix(tables["documents"]).collect()
    per = {}
    for r in got:
        per.setdefault(r.source, []).append(r)
    for rows in per.values():
        target, taken = rows[0].target, sum(r.taken for r in rows)
        assert abs(taken - target) <= max(3, 0.01 * target)
        assert all(0 <= r.copies <= 3 for r in rows)


def test_last_gap_against_every_choice_of_copies(spark):
    """Sources of a few documents: no single further move would come nearer."""
    rows = [(i, edge_cases.prose(i, 1 + (i * 37) % 60), f"s{i % 8}") for i in range(48)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for s in {r.source for r in got}:
        mine = [r for r in got if r.source == s]
        gap = mine[0].target - sum(r.taken for r in mine)
        spare = [r.size for r in mine if r.copies <= r.rate and r.copies < 3 and r.rate < 3 - 1e-9]
        given = [r.size for r in mine if r.copies > r.rate]
        assert all(abs(gap - x) >= abs(gap) - 1e-6 for x in spare) or all(abs(gap + x) >= abs(gap) - 1e-6 for x in given) or abs(gap) <= 0.05 * mine[0].target


def test_one_text_per_sampled_id(spark):
    docs = spark.createDataFrame([(7, f"text {i}") for i in range(200)] + [(8, "other"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 1), (None, 1)], "doc_id long, toxic int")
    got = labelled_sample(docs, labels, ["toxic"]).collect()
    assert sorted((r.doc_id, r.text, r.y_toxic) for r in got) == [(7, "text 0", 1), (8, "other", 0)]
