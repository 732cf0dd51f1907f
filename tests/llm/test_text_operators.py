import random
import re

import pytest
from pyspark.sql import functions as F

from aggrex.llm import decontaminate, paragraphs, pii, quality, toxicity, url_lists
from aggrex.llm.common import fold
from plain import edit_distance_within, pii_base

SF = "/root/testdata/sf0.1"


# --- toxicity and quality

@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_finds_held_out_toxic_documents(labelled):
    docs, labels = labelled
    model = toxicity.learn(docs, labels.where(fold("doc_id") != 1))
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 2
    got = toxicity.score(docs, model).withColumnRenamed("toxic", "found").join(
        labels.where(fold("doc_id") == 1), "doc_id")
    n = {(r.toxic, r.found): r["count"] for r in got.groupBy("toxic", "found").count().collect()}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) >= 0.85
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) >= 0.99
    assert got.where("expected_severity < 0 or expected_severity > 2 or p_toxic < 0 or p_toxic > 1").isEmpty()
    assert got.where("(grade > 0) <> found").isEmpty()


def test_cumulative_link_orders_grades():
    rows = [[], [0], [0, 1]] * 40
    w, t = toxicity.fit_cumulative_link(rows, [0, 1, 2] * 40, 2, 3)
    model = toxicity.OrdinalModel({"a": 0, "b": 1}, w, t)
    severity = [sum(model.at_least(r)) for r in rows[:3]]
    assert t[0] < t[1] and severity == sorted(severity) and severity[0] < 0.5 and severity[2] > 1.5


def test_toxicity_of_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (8, 1), (None, 1), (2, None), (1, 0)], "doc_id long, toxic int")
    for docs in (odd_docs, no_docs):
        model = toxicity.learn(docs, labels)
        assert toxicity.score(docs, model).count() == docs.count()
        kept = toxicity.drop_toxic(docs, model)
        assert kept.columns == docs.columns
    none = toxicity.learn(odd_docs, labels.where("false"))
    assert toxicity.score(odd_docs, none).where("toxic").isEmpty()
    assert toxicity.drop_toxic(odd_docs, none).count() == odd_docs.count()


def test_quality_tells_held_out_documents(labelled):
    docs, labels = labelled
    got = quality.score(docs, quality.learn(docs, labels)).join(labels, "doc_id").where("held_out")
    n = {(r.quality, r.predicted): r["count"] for r in got.groupBy("quality", "predicted").count().collect()}
    assert (n[0, 0] + n[1, 1]) / sum(n.values()) >= 0.97
    assert n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) >= 0.9
    assert got.where("held_out <> (pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1)").isEmpty()


def test_quality_reads_no_held_out_label(labelled):
    docs, labels = labelled
    lies = labels.withColumn("quality", F.when(fold("doc_id") == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.learn(docs, labels), quality.learn(docs, lies)
    assert a == b


def test_quality_of_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (8, 1), (None, 1), (2, None), (1, 1)], "doc_id long, quality int")
    for docs in (odd_docs, no_docs):
        got = quality.score(docs, quality.learn(docs, labels)).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    model = quality.learn(*[x for x in (odd_docs, labels.where("false"))])
    assert model is None and {r.score for r in quality.score(odd_docs, model).collect()} == {0.5}


def test_labels_beyond_0_and_1_and_one_id_at_many_texts(spark, monkeypatch):
    """Labels above 0 count as 1; samples are bounded by rows, not by ids."""
    rows = [(i, ("good calm words here " if i % 2 else "vile nasty rude speech ") * 5 + f"n{i} m{i}") for i in range(120)]
    rows += [(1, f"another text of the same id {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, [0, 1, 2, 7, -3][i % 2 * 4 if i % 2 else 1 + i % 3], i % 2 * 5)
                                    for i in range(120)], "doc_id long, toxic int, quality int")
    model = toxicity.learn(docs, labels, sample_rows=100)
    assert toxicity.score(docs, model).count() == len(rows)
    plain = labels.selectExpr("doc_id", "int(toxic > 0) toxic", "int(quality > 0) quality")
    assert toxicity.learn(docs, plain, sample_rows=100) == model
    assert toxicity.learn(docs, labels).features
    for name in ("SAMPLE_ROWS", "CALIBRATION_ROWS"):
        monkeypatch.setattr(quality, name, 30)
    assert quality.learn(docs, labels) == quality.learn(docs, plain)


# --- personal data

def _compare_pii(table):
    got = {(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.pii_report(table).collect()}
    assert got == {(r.doc_id, *pii_base(r.text)) for r in table.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", ["docs", "odd_docs", "no_docs"])
def test_pii_base_spans(name, request):
    _compare_pii(request.getfixturevalue(name))


def test_pii_base_spans_of_random_and_very_long_texts(spark):
    random.seed(3)
    letters = list("ab1234567890._%+-@@ ..é\U0001F600\n()|") + [
        "192.168.1.", "4111 1111 1111 1111", "a@b.c", "+1 (555) 123-4567", "@x.y", "00012"]
    texts = ["".join(random.choices(letters, k=random.randint(0, 40))) for _ in range(3000)]
    texts += ["1" * 20000, "a@b." * 9000, "1.2.3.4 " * 9000, "x" * 60000, "+" + "1(" * 30000, "12 " * 8000,
              "1." * 20000 + "x", "aA1 " * 9000, "DE89" * 4000]
    _compare_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4))


def test_pii_added_kinds_need_checksum_and_context(spark):
    texts = ["iban DE89370400440532013000 and DE89 3704 0044 0532 0130 00.", "DE88370400440532013000",
             "ssn 078-05-1120", "078-05-1120", "social security 000-05-1120", "order test ssn 078-05-1120"]
    got = [r.spans for r in pii.pii_report(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string").coalesce(1)).orderBy("doc_id").collect()]
    assert got[0] == "iban:5:27,iban:32:59" and "iban" not in got[1]
    assert got[2] == "ssn:4:15" and got[3] == "" and got[4] == ""
    assert got[5] == ""  # a word against it takes back what the word for it gave


def test_context_raises_and_lowers_every_kind(spark):
    said = [("mail me: a@b.co", "100"), ("contact a@b.co", "100"), ("a@b.co", "90"), ("for example a@b.co", "65"),
            ("1.2.3.4", "60"), ("our server 1.2.3.4", "85"), ("version 1.2.3.4", "35"),
            ("server version 1.2.3.4", "60"), ("card 4111 1111 1111 1111", "100"), ("4111 1111 1111 1111", "80"),
            ("order no. 4111 1111 1111 1111", "55"), ("call +1 (555) 123-4567", "95"),
            ("invoice +1 (555) 123-4567", "45"), ("ssn 078-05-1120", "65"),
            ("version " + "." * 40 + " 1.2.3.4", "60"), ("1.2.3.4 is a test", "35"), ("contest 1.2.3.4", "60"),
            ("a@b.co, 1.2.3.4 on that host", "90,85"), ("", ""), (None, "")]
    got = [r.scores for r in pii.pii_report(spark.createDataFrame(
        [(i, t) for i, (t, _) in enumerate(said)], "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == [s for _, s in said]


def test_redaction_keeps_rows_and_columns(odd_docs):
    got = pii.redact(odd_docs)
    assert got.columns == odd_docs.columns and got.count() == odd_docs.count()
    text = got.where("doc_id = 8").first().text
    assert text == "mail <EMAIL> card <CARD> ip <IP> tel <PHONE>"
    assert got.where("doc_id = 2").first().text is None
    assert {r.pii for r in got.collect()} == {r.pii for r in odd_docs.collect()}


# --- decontamination

def test_bit_parallel_edit_distance():
    random.seed(1)
    for _ in range(300):
        item = random.choices("abc", k=random.randint(1, 70))
        text = random.choices("abc", k=random.randint(0, 90))
        assert decontaminate.edit_distance_within(item, text) == edit_distance_within(item, text)


def test_benchmark_matches_equal_brute_force(spark):
    """Every text against every item by plain edit distance, on edited and exact passages."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 60
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(12, 40)))) for i in range(25)]
    items += [(100, "too short"), (101, None), (None, items[0][1]), (102, "")]
    docs, wanted = [], set()
    for d in range(150):
        words = rng.choices(vocabulary, k=rng.randint(0, 120))
        if d % 2:
            item = items[rng.randrange(25)][1].split()
            for _ in range(rng.randrange(0, decontaminate.budget(len(item)) + 3)):
                at = rng.randrange(len(item))
                item[at:at + 1] = [[f"new{rng.random()}"], [], [item[at], "and"]][rng.randrange(3)] or []
            at = rng.randrange(len(words) + 1)
            words[at:at] = item
        docs.append((d, (" " if d % 3 else "\n").join(words).title()))
    docs += [(500, None), (501, ""), (None, items[1][1]), (7, docs[7][1])]
    for d, t in docs:
        for i, x in items:
            if i is not None and x and len(x.split()) >= decontaminate.LEAST_WORDS:
                n = len(x.split())
                if t and edit_distance_within(x.split(), t.lower().split()) <= decontaminate.budget(n):
                    wanted.add((d, i))
    got = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)),
        spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(2)))
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    assert found <= wanted  # nothing beyond the edit distance
    assert len(found) >= 0.95 * len(wanted) and (None, 1) in found
    kept = decontaminate.drop_contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                           spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in kept.collect()}.isdisjoint({d for d, _ in found})
    assert kept.count() == len([1 for d, _ in docs if d not in {x for x, _ in found}])


@pytest.mark.parametrize("least, most", [(5, 9), (10, 14), (15, 17), (18, 24), (25, 34), (35, 60)])
def test_edited_copies_of_every_length_are_found(least, most):
    """Copies with as many edits as the item may have, among many long items that could hide short ones."""
    rng = random.Random(least)
    items = [(i, _prose(rng, rng.randint(least, most))) for i in range(40)]
    items += [(100 + i, _prose(rng, 60)) for i in range(60)]
    scanner = decontaminate.Scanner(decontaminate.build_index(items))
    found, of = 0, 0
    for i, text in items[:40] * 5:
        words = text.split()
        for _ in range(decontaminate.budget(len(words))):
            at = rng.randrange(len(words))
            words[at:at + 1] = [["new"], [words[at], "new"], []][rng.randrange(3)]
        around = [_prose(rng, rng.randrange(20, 40)) for _ in range(2)]
        found += i in {m[1] for m in scanner.matches([f"{around[0]} {' '.join(words)} {around[1]}"])}
        of += 1
    assert found == of if most < decontaminate.SHORT else found >= 0.94 * of


def test_decontamination_of_odd_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    got = decontaminate.contaminated(odd_docs, items).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == ["1", "1", "None"] and {r.edits for r in got} == {0}
    assert decontaminate.contaminated(no_docs, items).isEmpty()
    assert decontaminate.contaminated(odd_docs, items.where("false")).isEmpty()
    kept = decontaminate.drop_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert decontaminate.drop_contaminated(odd_docs, items.where("false")).count() == odd_docs.count()


def test_items_are_sent_in_slices(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 30 * decontaminate.WORD_BYTES)
    items = [(i, " ".join(f"i{i}w{j}" for j in range(15))) for i in range(8)]
    docs = [(i, "before it " + t + " after it") for i, t in items]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, i) for i in range(8)]


def test_an_index_is_bounded_by_its_own_bytes(spark, monkeypatch):
    """Items whose index would take over 100 MB come in slices that each keep the bound, long and short items alike."""
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(50_000)}" for _ in range(rng.choice([6, 20, 300, 900])))) for i in range(700)]
    words = sum(len(t.split()) for _, t in items)
    assert words * decontaminate.WORD_BYTES > 100 << 20
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 16 << 20)
    monkeypatch.setattr(decontaminate, "_tuned", lambda items: (decontaminate.KEYS[-1], {0}))  # the largest index
    slices, seen = 0, 0
    for index in decontaminate._slices(decontaminate._items(
            spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")):
        assert index.nbytes() <= 16 << 20
        slices, seen = slices + 1, seen + len(index.ids)
    assert seen == 700 and slices >= 6


def test_items_of_equal_text_are_found_under_each_id(spark):
    text = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, text), (2, text), (2, text), (3, "a b c d e f"), (3, text.title()), (None, text)],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(5, f"x {text} y"), (6, "a b c d x f g")], "doc_id long, text string")
    got = decontaminate.contaminated(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in got) == [
        (5, 1, 0), (5, 2, 0), (5, 2, 0), (5, 3, 0), (6, 3, 1)]


def test_pieces_are_cut_where_words_are_rare():
    counts = {"the": 500, "of": 400, "a": 300, "rare": 1, "odd": 2}
    bounds = decontaminate.cuts("the of rare the of a odd the a".split(), counts, 2)
    a, b = bounds[1:2] * 2
    assert bounds[0] == 0 and bounds[-1] == 9 and 3 <= b <= 6  # a rare word on either side
    for n in range(5, 25):
        pieces = decontaminate.budget(n) + 1
        bounds = decontaminate.cuts(["the"] * n, counts, pieces)
        assert len(bounds) == pieces + 1 and all(y > x for x, y in zip(bounds, bounds[1:]))


def test_hot_pieces_lead_to_few_candidates():
    """A piece on every line of a long text is looked at together; candidates are where the rest of the item is near."""
    items = [(i, f"in the year of our lord name{i}") for i in range(300)] + [(300, "of the in a the of in the a of")]
    scanner = decontaminate.Scanner(decontaminate.build_index(items, 4, {0}))
    text = ("in the year of our " * 4000) + "in the year of lord name7 " + "in the year of our " * 10
    found = scanner.candidates([decontaminate._words(text)])
    assert {i for _, i, _ in found} == {7}
    assert {m[1] for m in scanner.matches([text])} == {7}


# --- paragraphs

def _prose(rng, n):
    return " ".join(f"{rng.choice('bcdfgh')}{rng.randrange(4000)}" for _ in range(n))


def test_repeated_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(9)
    passage, near = _prose(rng, 130), None
    near = passage.split()
    near[35] = "changed"
    near = " ".join(near)
    docs = [(1, f"{_prose(rng, 33)} {passage} {_prose(rng, 51)}"), (2, f"{_prose(rng, 80)}\n{passage}"),
            (3, _prose(rng, 200)), (4, f"{_prose(rng, 20)} {near} {_prose(rng, 40)}"), (5, _prose(rng, 6)),
            (6, f"{_prose(rng, 60)} License line of five words\n"), (7, f"{_prose(rng, 61)} License line of five words"),
            (2, None), (None, passage), (8, None), (9, "")]
    docs[7:8] = []
    table = spark.createDataFrame(docs + [docs[2]], "doc_id long, text string").withColumn("n", F.lit(0))
    got = {r.doc_id: r for r in paragraphs.repeated_report(table).collect() if r.doc_id is not None}
    assert {d for d, r in got.items() if r.n_removed} == {2, 4}
    assert got[2].of_docs == [1] and got[2].removed_words >= 45
    texts = dict(docs)
    for d in (2, 4):
        for span in got[d].removed.split(","):
            a, b = map(int, span.split(":"))
            cut = texts[d].split()[a:b]
            assert sum(w in passage for w in cut) >= 0.9 * len(cut)
    left = {r.doc_id: r.text for r in paragraphs.remove_runs(table, paragraphs.repeated_runs(table)).collect()}
    assert left[3] == texts[3] and left[1] == texts[1] and left[8] is None
    assert len(left[2].split()) == len(texts[2].split()) - got[2].removed_words


def _removed_words(report):
    return {r.doc_id: {i for x in r.removed.split(",") if x for i in range(*map(int, x.split(":")))}
            for r in report.collect()}


def test_a_changed_word_inside_a_passage_of_70(spark):
    rng = random.Random(9)
    passage = _prose(rng, 70)
    near = passage.split()
    near[35] = "changed"
    texts = {1: f"{_prose(rng, 33)} {passage} {_prose(rng, 51)}", 2: f"{_prose(rng, 80)}\n{passage}",
             3: _prose(rng, 200), 4: f"{_prose(rng, 20)} {' '.join(near)} {_prose(rng, 40)}"}
    got = {r.doc_id: r for r in paragraphs.repeated_report(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert {d for d, r in got.items() if r.n_removed} == {2, 4} and got[2].removed_words >= 69
    for d in (2, 4):
        for span in got[d].removed.split(","):
            a, b = map(int, span.split(":"))
            cut = texts[d].split()[a:b]
            assert sum(w in passage for w in cut) >= len(cut) - 1


@pytest.mark.parametrize("edit", ["none", "replaced", "inserted", "dropped"])
def test_passages_of_51_to_60_words_are_removed_to_their_borders(spark, edit):
    docs, span = [], {}
    for seed in range(200):
        rng = random.Random(seed)
        passage = _prose(rng, rng.randint(51, 60)).split()
        copy, at = list(passage), rng.randrange(51)
        copy[at:at + 1] = {"none": [copy[at]], "replaced": ["changed"], "inserted": [copy[at], "added"],
                           "dropped": []}[edit]
        # At the end of a text, or with so much around it that the lines are unlike.
        before, after = (rng.choice([0, rng.randint(30, 90)]) for _ in range(2))
        docs += [(seed, " ".join([_prose(rng, rng.randint(30, 90)), *passage, _prose(rng, rng.randint(30, 90))])),
                 (1000 + seed, " ".join([_prose(rng, before), *copy, _prose(rng, after)]))]
        span[1000 + seed] = set(range(before, before + len(copy)))
    got = _removed_words(paragraphs.repeated_report(spark.createDataFrame(docs, "doc_id long, text string")))
    # A part at the border may be linked, and removed whole, as a near copy.
    assert all(len(got[d] - span[d]) <= 3 if d in span else not got[d] for d in got)
    assert sum(got[d] <= s for d, s in span.items()) >= 0.95 * len(span)
    least = 1 if edit == "none" else 0.9
    assert sum(len(got[d]) >= least * len(s) for d, s in span.items()) >= (1 if edit == "none" else 0.99) * len(span)


def test_similar_lines_are_removed_whole(spark):
    """Ten words in a row and single words changed: Jaccard of the lines over 0.8, inner parts unlike."""
    rng = random.Random(4)
    line = _prose(rng, 200).split()
    near = line[:90] + _prose(rng, 10).split() + line[100:]
    docs = [(1, " ".join(line)), (2, _prose(rng, 30) + "\n" + " ".join(near))]
    got = _removed_words(paragraphs.repeated_report(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == {1: set(), 2: set(range(30, 230))}


def test_anchors_are_dense_and_stand_in_every_run_of_25_words():
    rng = random.Random(2)
    passage = _prose(rng, 25)
    texts = [f"{_prose(rng, rng.randrange(60))} {passage} {_prose(rng, rng.randrange(60))}" for _ in range(50)]
    cutter = paragraphs.Cutter()
    p = cutter.paragraphs(texts + ["", "one", "the " * 500])
    place, anchor = cutter.anchors(p)
    of = p["word_text"][place]
    assert set.intersection(*[set(anchor[of == i].tolist()) for i in range(50)])
    assert (of == 52).sum() <= 70 and (of < 50).sum() <= 0.15 * (p["word_text"] < 50).sum()


def test_similar_paragraphs_link_by_exact_jaccard():
    import numpy as np
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 10 ** 9, 20)
        sets += [np.unique(base), np.unique(np.append(base[:18], rng.integers(0, 10 ** 9, 2))),
                 np.unique(np.append(base[:12], rng.integers(0, 10 ** 9, 8)))]
    links = paragraphs._similar_pairs(sets, list(range(90)), list(range(90)), 0.8)
    from plain import Groups
    a, b = Groups(90), Groups(90)
    for i, j in links:
        a.join(i, j)
    for i in range(90):
        for j in range(i):
            if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])):
                b.join(i, j)
    assert [a.root(i) for i in range(90)] == [b.root(i) for i in range(90)]


def test_a_bucket_of_many_paragraphs_is_dealt_in_slices(spark, monkeypatch):
    monkeypatch.setattr(paragraphs, "UNIT_ROWS", 8)
    rows = [(1, c, [x for x in range(10)] + [100 + c]) for c in range(60)]
    links = paragraphs._verified_links(
        spark.createDataFrame([(k, c) for k, c, _ in rows], "key long, content long"),
        spark.createDataFrame([(c, s) for _, c, s in rows], "content long, shingles array<long>"), 0.8).collect()
    from plain import Groups
    groups = Groups(60)
    for r in links:
        groups.join(r.a, r.b)
    assert {groups.root(i) for i in range(60)} == {0}


def test_bands_reach_the_recall():
    b = paragraphs.bands_for()
    assert 1 - (1 - paragraphs.SIMILARITY ** paragraphs.ROWS) ** b >= paragraphs.RECALL


def test_paragraphs_of_odd_tables(odd_docs, no_docs):
    assert paragraphs.repeated_report(no_docs).count() == 0
    got = paragraphs.repeated_report(odd_docs)
    assert got.count() == odd_docs.count()
    assert not got.where("doc_id = 1 and n_removed > 0").count()  # a repeated row is one document
    assert paragraphs.remove_runs(odd_docs, paragraphs.repeated_runs(odd_docs)).columns == odd_docs.columns


# --- URL lists

def test_url_lists_as_of_the_fetch(spark):
    events = spark.createDataFrame([
        ("host", "a.example.com", "x", "add", "2023-02-10"), ("host", "a.example.com", "x", "remove", "2023-03-10"),
        ("host", "A.example.com", "y", "add", "2023-05-01"), ("domain", "example.org", "d", "add", "2023-01-01"),
        ("prefix", "b.example.net/bad/", "p", "add", "2023-01-01"), ("prefix", "b.example.net/one", "q", "add", "2023-01-01"),
        ("host", "c.net", "z", "remove", "2023-01-05"), ("host", "c.net", "z", "add", "2023-01-05"),
        ("host", None, "z", "add", "2023-01-05"), (None, "c.net", "z", "add", "2023-01-05"),
        ("host", "c.net", "z", "add", None), ("host", "c.net", "z", "rename", "2023-01-06")],
        "kind string, entry string, category string, action string, day string").withColumn(
        "event_date", F.to_date("day"))
    pages = [
        (1, "https://a.example.com/", "2023-02-09"), (2, "https://a.example.com/", "2023-02-10"),
        (3, "https://a.example.com/", "2023-03-09"), (4, "https://a.example.com/", "2023-03-10"),
        (5, "http://user@A.EXAMPLE.com:80/x?y", "2023-06-01"), (6, "https://deep.sub.example.org/x", "2023-02-01"),
        (7, "https://badexample.org/", "2023-02-01"), (8, "https://b.example.net/bad/thing.html#top", "2023-02-01"),
        (9, "https://b.example.net/badly", "2023-02-01"), (10, "https://b.example.net/one?q=1", "2023-02-01"),
        (11, "https://b.example.net/one/two", "2023-02-01"), (12, "https://c.net.", "2023-01-05"),
        (13, None, "2023-01-05"), (14, "not a url", "2023-01-05"), (15, "https://c.net/", None),
        (16, "https://" + "a." * 3000 + "example.org/" + "d/" * 3000, "2023-02-01"),
        (17, "https://c.net/", "2023-01-06"), (17, "https://c.net/", "2023-01-06"), (None, "https://c.net/", "2023-01-06")]
    captures = spark.createDataFrame(pages, "page_id long, url string, day string").withColumn(
        "fetch_date", F.to_date("day")).withColumn("key", F.lit("clash"))
    intervals = url_lists.validity_intervals(events)
    got = {r.page_id: r for r in url_lists.filter_captures(captures, intervals).collect()}
    assert len(got) == len({p for p, _, _ in pages})
    assert {p for p, r in got.items() if r.blocked} == {2, 3, 5, 6, 8, 10, 12, 16, 17, None}
    assert got[5].categories == "y" and got[2].categories == "x" and str(got[2].first_listed) == "2023-02-10"
    assert url_lists.filter_captures(captures.where("false"), intervals).isEmpty()
    assert url_lists.filter_captures(captures, intervals.where("false")).where("blocked").isEmpty()


def test_paths_of_prefix_entries_keep_their_case(spark):
    events = spark.createDataFrame([("prefix", "B.example.net/Bad/Thing", "p"), ("host", "C.Example.net", "h")],
                                   "kind string, entry string, category string").withColumns(
        {"action": F.lit("add"), "event_date": F.to_date(F.lit("2023-01-01"))})
    pages = [(1, "https://b.Example.net/Bad/Thing"), (2, "https://b.example.net/bad/thing"),
             (3, "https://b.example.net/Bad/Thing?q"), (4, "https://c.example.net/X"), (5, "https://b.example.net/Bad/")]
    captures = spark.createDataFrame(pages, "page_id long, url string").withColumn(
        "fetch_date", F.to_date(F.lit("2023-02-01")))
    got = url_lists.filter_captures(captures, url_lists.validity_intervals(events)).where("blocked")
    assert {r.page_id for r in got.collect()} == {1, 3, 4}
