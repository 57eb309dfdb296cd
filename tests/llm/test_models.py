"""Classifiers, the language model, vectors, pages and the pipeline."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from duewatch.llm import bilinear, lm, markup, ordinal, pages, robust, screening, string_kernel, toxicity, vectors
from duewatch.llm.queries import QUERIES
from tests.llm.conftest import prose

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def insults(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        text, toxic = prose(rng, rng.randrange(10, 60)), int(i % 5 == 0)
        if toxic:
            cut = text.split()
            cut.insert(rng.randrange(len(cut)), rng.choice(["grobnik", "velmadon", "tristo"]) + rng.choice(["", "as", "el", "um"]))
            text = " ".join(cut)
        rows.append((i, text))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_documents(insults, odd_docs, no_docs):
    docs, labels = insults
    report = toxicity.toxicity_report(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in report]) > 0.98
    model = toxicity.train_toxicity(docs, labels)
    spelled = docs.sparkSession.createDataFrame(
        [(t,) for t in ("so grob-nik and", "so g r o b n i k and", "so Grobnik! and", "so velmmadon and")], "text string"
    )
    assert all(r.s > 0.3 for r in spelled.select(model.score(F.col("text")).alias("s")).collect())
    assert toxicity.toxicity_report(odd_docs, labels).count() == odd_docs.count()
    clean = toxicity.clean_documents(odd_docs, labels.limit(0))
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count()
    assert toxicity.toxicity_report(no_docs, labels).count() == 0


def test_probabilities_do_not_depend_on_the_sample(spark):
    rows = [(i, "the same few words in another order".split()) for i in range(400)]
    docs = spark.createDataFrame([(i, " ".join(w[i % 7 :] + w[: i % 7])) for i, w in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int")
    share = labels.filter(~toxicity.held_out_rows("doc_id", 4, 2)).agg(F.avg("toxic")).head()[0]
    for most in (30, 6000):
        model = toxicity.train_toxicity(docs, labels, most_per_label=most)
        assert docs.select(F.avg(model.score(F.col("text")))).head()[0] == pytest.approx(share, abs=0.02)


def test_string_kernel_is_the_sum_over_subsequences():
    def force(s, t):
        def parts(word):
            codes = string_kernel.encoded([word])[0][0].tolist()
            total = collections.Counter()
            for steps in string_kernel.STEPS:
                for i in range(len(codes) - sum(steps)):
                    at = [i, *(i + sum(steps[: k + 1]) for k in range(len(steps)))]
                    total[tuple(codes[a] for a in at)] += string_kernel.DECAY ** sum(steps)
            return total

        a, b = parts(s), parts(t)
        norm = string_kernel.norms(np.array([len(s), len(t)]))
        return sum(a[k] * b[k] for k in a) / norm[0] / norm[1]

    words = ["insult", "insxult", "result", "abc"]
    place, features = string_kernel.landmark_features(words)
    found = string_kernel.kernel(words, place, features)
    for i, s in enumerate(words):
        for j, t in enumerate(words):
            assert found[i, j] == pytest.approx(force(s, t), rel=1e-4, abs=1e-6)


def test_grades_are_ordered_and_learned(spark, odd_docs, no_docs):
    rng = random.Random(4)
    vocab = [["bad", "awful", "poor"], ["fair", "usual", "plain"], ["fine", "great", "good"]]
    rows = [(i, " ".join(rng.choice(vocab[i % 3]) if rng.random() < 0.3 else f"w{rng.randrange(99)}" for _ in range(40)))
            for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ratings = spark.createDataFrame([(i, i % 3) for i in range(400)], "doc_id long, grade int")
    model = ordinal.train_grades(docs, ratings)
    assert (np.diff(model.thresholds) > 0).all()
    report = ordinal.grade_report(docs, model).collect()
    assert all(abs(sum(r.tail_probabilities) - r.expected_grade) < 1e-9 for r in report)
    error = np.mean([abs(round(r.expected_grade) - r.doc_id % 3) for r in report if r.doc_id >= 400])
    assert error < 0.1
    assert ordinal.grade_report(odd_docs, model).count() == odd_docs.count()
    assert ordinal.grade_report(odd_docs, ordinal.train_grades(no_docs, ratings)).count() == odd_docs.count()


def test_robust_estimates_ignore_outliers(spark):
    rng = np.random.default_rng(0)
    good, far = rng.normal(0, 1, (900, 4)), rng.normal(9, 0.1, (200, 4))
    rows = [("a", *map(float, r)) for r in np.concatenate([good, far])]
    table = spark.createDataFrame(rows, "key string, a double, b double, c double, d double")
    found = robust.mcd_estimates(table, list("abcd"), [0.01] * 4).head()
    assert np.abs(found["centre"]).max() < 0.2
    spread = np.linalg.inv(np.array(found["inverse"]).reshape(4, 4))
    assert 0.6 < np.linalg.det(spread) ** 0.25 < 1.5


def test_language_model(spark, odd_docs, no_docs):
    rows = lm.language_model_scores(odd_docs, block_bytes=3000, range_bytes=4000).collect()
    tokens = [([w.lower() for w in (r.text or "").encode().split()] + [b" "], r.doc_id) for r in odd_docs.collect()]
    counts = collections.Counter()
    for own, key in tokens:
        if key is None or zlib.crc32(str(key).encode()) % 5 != 1:
            counts.update(own)
    total, distinct = sum(counts.values()), len(counts)
    expected = sorted(
        (len(own), sum(counts[w] > 0 for w in own),
         round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own), 4)) for own, _ in tokens
    )
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 4)) for r in rows) == expected
    assert {r.train_tokens for r in rows} == {total} and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert lm.language_model_scores(no_docs).count() == 0


def _score_of(model, classes, counts, total_of, text):
    """One document's log10 probability, token by token."""
    score, before = 0.0, [len(model.bias)] * bilinear.CONTEXT
    for word in [*(text or "").encode().lower().split(), b" end"]:
        number = lm._numbered(word)
        own = int(classes.of(np.array([number], np.uint64))[0])
        hidden = sum(model.inputs[c].astype(float) * model.places[i] for i, c in enumerate(before))
        scores = model.outputs.astype(float) @ hidden + model.bias
        score += (scores[own] - np.log(np.exp(scores).sum())) / math.log(10)
        if own >= len(classes.short):
            score += math.log10((counts[number] + 0.5) / total_of[own])
        before = [own, *before[:-1]]
    return score


def test_language_model_scores_follow_the_model_and_no_partitions(spark, odd_docs, monkeypatch):
    """Scores equal a token-by-token evaluation of the last model, for every way the rows are dealt."""
    models = []
    kept = lm._scored
    monkeypatch.setattr(lm, "_scored", lambda model, *rest: models.append(model) or kept(model, *rest))
    found_classes = []
    merged = lm._classes
    monkeypatch.setattr(lm, "_classes", lambda reports: found_classes.append(merged(reports)) or found_classes[-1])
    runs = [
        sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm.language_model_scores(
            odd_docs.repartition(parts), block_bytes=1500, range_bytes=4000).collect())
        for parts in (1, 6)
    ]
    assert runs[0] == runs[1]
    counts = collections.Counter()
    rows = odd_docs.collect()
    for r in rows:
        if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 != 1:
            counts.update(lm._numbered(w) for w in [*(r.text or "").encode().lower().split(), b" end"])
    classes = found_classes[-1]
    total_of = collections.Counter()
    for number, n in counts.items():
        total_of[int(classes.of(np.array([number], np.uint64))[0])] += n + 0.5
    total_of = {c: total_of[c] + 0.5 for c in range(len(classes.frequencies))}
    expected = sorted(
        (str(r.doc_id), len((r.text or "").split()), _score_of(models[-1], classes, counts, total_of, r.text))
        for r in rows if r.text is None or len(r.text) < 20_000
    )
    wanted = {}
    for key, _, score in expected:
        wanted.setdefault(key, []).append(score)
    for key, _, score in runs[0]:
        if key in wanted and len(wanted[key]) == 1:
            assert score == pytest.approx(wanted[key][0], rel=1e-4, abs=1e-3)


def test_models_are_averaged_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN", 3)
    rng = np.random.default_rng(0)
    own = [(i, float(i % 5 + 1), rng.normal(size=4)) for i in range(20)]
    table = spark.createDataFrame([(i, w, m.tobytes()) for i, w, m in own], "unit int, weight double, model binary")
    assert lm._averaged(table, 20) == pytest.approx(np.average([m for *_, m in own], axis=0, weights=[w for _, w, _ in own]))


def test_class_probabilities_sum_to_one_and_learn_contexts():
    rng = np.random.default_rng(0)
    classes = np.where(np.arange(60_000) % 2 == 0, rng.integers(0, 5, 60_000), rng.integers(5, 10, 60_000))
    frequencies = np.bincount(classes, minlength=10) / len(classes)
    model = bilinear.fresh(frequencies)
    trainer = bilinear.Trainer(model, frequencies, 1)
    contexts = bilinear.contexts_of(classes, np.array([0]), 10)
    trainer.learn(contexts, classes)
    after = trainer.model.log10_probability(contexts, classes).mean()
    assert after > model.log10_probability(contexts, classes).mean() + 0.15
    every = trainer.model.log10_probability(np.repeat(contexts[:1], 10, 0), np.arange(10))
    assert (10**every).sum() == pytest.approx(1, abs=1e-4)


def test_similar_vectors_against_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(3000, 32))
    near = np.concatenate([base[i] + rng.normal(0, s, (m, 32)) for i, s, m in ((0, 0.1, 300), (1, 0.2, 40), (2, 0.25, 30))])
    data = np.concatenate([base, near, base[5:8], base[5:6]])
    units = data / np.linalg.norm(data, axis=1)[:, None]
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(data)]
    odd = [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, [1.0, 2.0], [1e200] * 32]
    rows += [(9000 + i, v, None) for i, v in enumerate(odd)] + [(None, rows[0][1], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key int")
    found = {r.vec_id: r for r in vectors.similar_vectors(table).collect()}
    assert len(found) == len(rows)
    alike = units @ units.T >= 0.95
    missed = alike.sum() - len(data) - sum(found[i].n_links for i in range(len(data)))
    assert 0 <= missed <= 0.001 * alike.sum()
    root = np.arange(len(data))
    for _ in range(20):
        root = np.where(alike, root[None], len(data)).min(axis=1)
    assert np.mean([found[i].component_id == root[i] for i in range(len(data))]) > 0.999
    assert all((found[9000 + i].n_links, found[9000 + i].kept) == (0, True) for i in range(7))
    assert found[None].component_id is None and found[None].kept
    assert vectors.representatives(table).columns == table.columns
    assert vectors.similar_vectors(table.limit(0)).count() == 0


def test_no_pair_of_similar_vectors_is_lost(spark, monkeypatch):
    """Vectors in a few dimensions of many, partners just above the threshold, and two lengths."""
    monkeypatch.setattr(vectors, "CELL", 40)
    rng = np.random.default_rng(2)
    rows, expected = [], {}
    for size, rank, count in ((256, 6, 1500), (16, 16, 300)):
        flat = np.linalg.qr(rng.normal(size=(size, rank)))[0]
        base = rng.normal(size=(count, rank))
        base /= np.linalg.norm(base, axis=1)[:, None]
        side = rng.normal(size=(count, rank))
        side -= (side * base).sum(axis=1)[:, None] * base
        side /= np.linalg.norm(side, axis=1)[:, None]
        alike = rng.uniform(0.951, 0.96, count)[:, None]
        units = np.concatenate([base, alike * base + np.sqrt(1 - alike**2) * side]) @ flat.T
        links = (units @ units.T >= 0.95).sum(axis=1) - 1
        for v, n in zip(units, links):
            expected[len(rows)] = n
            rows.append((len(rows), v.tolist()))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in vectors.similar_vectors(table).collect()}
    assert found == expected
    narrow = table.filter("size(embedding) = 16").withColumn("embedding", F.col("embedding").cast("array<float>"))
    assert {r.vec_id: r.n_links for r in vectors.similar_vectors(narrow).collect()}.items() <= expected.items()


def test_vectors_without_partners_are_not_copied_to_cells(spark, monkeypatch):
    """What is written for the comparison follows the similar vectors, not the square of all."""
    from duewatch.llm.scratch import Scratch

    written, put = {}, Scratch.put

    def counted(self, df, name):
        table = put(self, df, name)
        written[name] = written.get(name, 0) + self.bytes_of(table)
        return table

    monkeypatch.setattr(Scratch, "put", counted)
    rng = np.random.default_rng(3)
    data = rng.normal(size=(16_000, 32)).astype(np.float32)
    data[15_900:] = data[:100] + rng.normal(0, 0.05, (100, 32))
    table = spark.createDataFrame(list(zip(range(len(data)), data.tolist())), "vec_id long, embedding array<float>")
    found = vectors.similar_vectors(table.repartition(4)).filter("n_links > 0").collect()
    assert {(r.vec_id, r.component_id) for r in found} == {(i, i % 15_900) for i in (*range(100), *range(15_900, 16_000))}
    assert sum(written[name] for name in ("cells", "homes", "guests")) < data.nbytes


def test_screening_keeps_every_similar_pair(spark, monkeypatch):
    """Vectors in a few dimensions of many, around one direction, with partners just above the threshold."""
    monkeypatch.setattr(vectors, "SCREENED", 100)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(3000, 5)) + [3, 0, 0, 0, 0]
    base /= np.linalg.norm(base, axis=1)[:, None]
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(axis=1)[:, None] * base
    side /= np.linalg.norm(side, axis=1)[:, None]
    alike = rng.uniform(0.9501, 0.952, 3000)[:, None]
    flat = np.linalg.qr(rng.normal(size=(48, 5)))[0]
    spread = rng.normal(size=(3000, 48))
    units = np.concatenate([np.concatenate([base, alike * base + np.sqrt(1 - alike**2) * side])[::4] @ flat.T, spread])
    units /= np.linalg.norm(units, axis=1)[:, None]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(units)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in vectors.similar_vectors(table).collect()}
    links = units @ units.T >= 0.95
    assert [found[i].n_links for i in range(len(units))] == (links.sum(axis=1) - 1).tolist()
    label = screening.joined(*np.nonzero(links), np.arange(len(units)))
    assert [found[i].component_id for i in range(len(units))] == label.tolist()


def test_crowded_buckets_and_late_rows_lose_no_partner(monkeypatch):
    monkeypatch.setattr(screening, "CROWD", 64)
    monkeypatch.setattr(screening, "HELD_BYTES", 2 * 16 * 300)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    data = np.concatenate([c + rng.normal(0, s, (250, 16)) for c, s in zip(centres, (0.02, 0.1, 0.2, 0.3, 0.5, 1))])
    units = (data / np.linalg.norm(data, axis=1)[:, None]).astype(np.float32)[rng.permutation(len(data))]
    scales = np.abs(units).max(axis=1) / 32767
    codes = np.rint(units / scales[:, None]).astype(np.int16)
    meeting = screening.Meeting(16, 0.95)
    for i in range(0, len(units), 100):
        part = slice(i, i + 100)
        meeting.add(np.full(len(codes[part]), 7), np.arange(len(units))[part], scales[part], codes[part])
    assert meeting.pivots
    label = screening.joined(*meeting.finish(), np.arange(len(units)))
    a, b = np.nonzero(units @ units.T >= 0.95)
    assert (label[a] == label[b]).all() and len(set(label)) > 200


def test_share_of_pairs_without_a_common_bucket():
    rng = np.random.default_rng(6)
    x = np.linalg.qr(rng.normal(size=(24, 2)))[0]
    pair = np.stack([x[:, 0], 0.95 * x[:, 0] + np.sqrt(1 - 0.95**2) * x[:, 1]])
    lost = 0
    for table in range(2000):
        a, b = screening.buckets((pair @ screening._directions(table, 24, 40)).astype(np.float32))
        lost += not set(a) & set(b)
    assert lost / 2000 < screening.missed(40, 24, 0.95) < 0.1
    directions, tables, _ = screening.plan(10**6, 64, 0.95)
    assert screening.missed(directions, 64, 0.95) ** tables <= screening.MISS
    assert screening.plan(10**6, 64, 0.3) is None and screening.plan(10**6, 4, 0.95) is None


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li>Menu<li>More</ul></nav><div class="ad">Buy</div>
<article><header><h1>Head &amp;  line</h1></header><p><b>First<br><p>Second &lt;x&gt;\n line</p><aside>Side</aside>
<ul><li>one<li>two</ul><form>Mail</form></article><div class="comments"><article>Nice</article></div><footer>&copy; 1</footer>"""


def test_main_text_of_a_marked_page():
    root = markup.parsed(PAGE)
    assert markup.block_texts(markup.main_part(root), True, set()) == ["Head & line", "First", "Second <x> line", "one", "two"]


def test_site_templates_are_deleted(spark):
    frame = "<body><div><p>Welcome to the site</p></div><div><p>Article {0} text.</p><p>Rest {0}.</p></div><div>Imprint</div></body>"
    rows = [(i, f"http://Host.example/{i}", frame.format(i), 1) for i in range(6)]
    rows += [(10, None, None, 1), (None, "http://other/", "<p>a", 1), (11, "http://other/", "", 1), rows[0]]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, key int")
    found = pages.main_texts(table).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert texts[3] == "Article 3 text.\n\nRest 3."
    assert texts[10] == "" and texts[11] == "" and texts[None] == "a"
    assert all(r.n_chars == len(r.text) for r in found)
    assert pages.main_texts(table.limit(0)).count() == 0


def page_texts(spark, pages_of):
    rows = [(i, f"http://host.example/{i}", page) for i, page in enumerate(pages_of)]
    found = pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(found, key=lambda r: r.page_id)]


def test_recurring_boxes_inside_an_article_are_deleted_and_copies_stay(spark):
    box = "<div class='x1'><p>Get our letter every week</p></div>"
    rng = random.Random(3)
    bodies = [[prose(rng, 30) for _ in range(4)] for _ in range(5)]
    edited = [[*bodies[0][:3], prose(rng, 30)] for _ in range(5)]
    every = bodies + [bodies[1]] * 6 + edited
    found = page_texts(
        spark, [f"<body><article><h1>News</h1><p>{b[0]}</p><p>{b[1]}</p>{box}<p>{b[2]}</p><p>{b[3]}</p></article>" for b in every]
    )
    assert all("letter" not in found[i] and found[i].startswith("News") for i in range(1, 11))
    assert all(p in text for b, text in zip(every, found) for p in b)


def test_templates_are_counted_on_different_pages(spark):
    """Without article or main: copies are no template, and a section's menu on a few of many pages is one."""
    rng = random.Random(8)
    frame = "<body><div>{0}</div><div><p>{1}</p><p>{2}</p></div></body>"
    bodies = [(prose(rng, 20), prose(rng, 20)) for _ in range(40)]
    every = [("Section menu of sports" if i < 5 else f"Note {i}", *b) for i, b in enumerate(bodies)]
    every += [("Copied", "one and the same", "text of a copy")] * 25
    found = page_texts(spark, [frame.format(*row) for row in every])
    assert all("menu" not in text for text in found)
    assert all(a in text and b in text for (_, a, b), text in zip(every, found))


@pytest.mark.parametrize("page, blocks", [
    ("<main><h1>Head</h1><p>A long text of the page</p><article class='card'>Teaser</article></main>",
     ["Head", "A long text of the page", "Teaser"]),
    ("<div><article>First part</article><article>The second part</article></div>", ["First part", "The second part"]),
    ("<article><p>Text</p><section id='discussion'><p>We discuss</p></section><p role='note'>Noted</p></article>",
     ["Text", "We discuss", "Noted"]),
    ("<main><article>A text</article><div class='related'>Other pages</div></main>", ["A text"]),
    ("<main><p>A text</p><div class='related'>Related work</div><div class='ads'>Buy</div></main>", ["A text", "Related work"]),
])
def test_whole_main_part(page, blocks):
    root = markup.parsed(page)
    assert markup.block_texts(markup.main_part(root), True, set()) == blocks


def test_deeply_nested_and_broken_pages():
    deep = markup.parsed("<div>" * 5000 + "x" + "</span>" * 10)
    markup.digested(deep)
    assert markup.block_texts(deep, False, set()) == ["x"]
    for text in ["<", "<p", "a < b", "<!-- never ends", "<script>x", "</p></div>", "<p a='>' b=\">\">y"]:
        markup.block_texts(markup.parsed(text), False, set())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "pipeline"))
def test_queries_return_a_row_per_row(spark, name):
    source = {"op3": "embeddings", "op9": "pages"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SMALL}/{source}.parquet").count()
    found = QUERIES[name](spark, SMALL).count()
    assert found >= rows if name.startswith("op2") else found == rows


def test_pipeline_stages(spark, odd_docs):
    import corpus_pipeline

    docs = odd_docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == odd_docs.columns
    final = QUERIES["pipeline"](spark, SMALL)
    assert final.count() > 0
    assert {r.doc_id for r in final.collect()} <= {r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def test_only_subtrees_of_the_main_part_can_be_deleted():
    from duewatch.llm.markup import deletable, digested_main, parsed, subtrees

    root = parsed("<nav><ul><li>menu here</li></ul></nav><article><p>one two three</p><div><b>box</b></div></article>")
    main = digested_main(root)
    found = deletable(main, True)
    assert 0 < len(found & set(subtrees(root, main))) < len(subtrees(root, main))
    assert found == {main.children[0].digest, main.children[1].digest, main.children[1].children[0].digest}
