import random
import re
import textwrap

import pytest

from lutrin.llm.licences import FRAMES, LIKELY, NOTICES, cues, find_licences, training_rows
from lutrin.llm.queries import op9_license_scan

from helpers import docs_of

WORDS = "the and of license version public general free to under with software terms thion erst ble".split()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    prose = lambda: " ".join(rng.choice(WORDS[:3] + WORDS[-3:]) for _ in range(20))
    texts = ["\n".join(prose() for _ in range(3)) for _ in range(60)]
    places = {}
    for i, (family, notices) in enumerate(NOTICES.items()):
        texts.append("\n".join([prose(), notices[0], prose(), notices[-1]]))
        places[len(texts) - 1] = [(1, family), (3, family)]
    texts += ["", None, "MIT", "Mit.", "The driver lost his license.", "x " * 4000 + "\n" + NOTICES["MIT"][0]]
    places[len(texts) - 1] = [(1, "MIT")]
    rows = find_licences(docs_of(spark, texts, clashes=True)).collect()
    return texts, places, {r.doc_id: r for r in rows}


def test_notices_are_found_and_prose_is_left_alone(corpus):
    texts, places, rows = corpus
    assert len(rows) == len(texts)
    for i in range(len(texts)):
        assert [(x.place, x.family) for x in rows[i].licences if x.confirmed] == places.get(i, []), texts[i]
        assert rows[i].n_paragraphs == len((texts[i] or "").split("\n"))


def test_probabilities_and_similarities(corpus):
    _, places, rows = corpus
    for i in places:
        for x in rows[i].licences:
            assert (LIKELY if x.confirmed else rows[i].threshold) < x.probability <= 1 and 0 <= x.similarity <= 1


def test_held_out_frames(spark):
    """Notices in surroundings that were not trained on."""
    pairs = [(f, n) for f, list_ in NOTICES.items() for n in list_]
    texts = [f"Note by the editor: {n} Thank you." for _, n in pairs]
    assert not any(t in frame for t in texts for frame in FRAMES)
    rows = {r.doc_id: r for r in find_licences(docs_of(spark, texts)).collect()}
    right = sum(any(x.family == f for x in rows[i].licences) for i, (f, _) in enumerate(pairs))
    assert right >= 0.85 * len(pairs)


def test_cues_lose_no_paragraph_that_a_family_can_win():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    for _ in range(40):
        grams = {w for w in words if rng.random() < 0.7} | {f"{rng.choice(words)} {rng.choice(words)}" for _ in range(8)}
        weights = [(g, [rng.uniform(-1, 1.5) for _ in range(3)]) for g in sorted(grams)]
        intercepts = [-rng.uniform(0, 3) for _ in range(3)]
        pattern = re.compile(cues(weights, intercepts, {w: rng.randrange(50) for w in words}).replace(r"\p{L}\p{N}", "a-z0-9").replace("(?iu)", "(?i)"))
        for _ in range(200):
            text = [rng.choice(words) for _ in range(rng.randint(1, 8))]
            own = set(text) | {f"{a} {b}" for a, b in zip(text, text[1:])}
            best = max(b + sum(v[f] for g, v in weights if g in own) for f, b in enumerate(intercepts))
            assert best <= 0 or pattern.search(" ".join(text))
    assert cues([("a", [1.0])], [0.5], {}) == ""


def test_ids_and_empty_table(spark):
    text = NOTICES["MIT"][0]
    rows = find_licences(docs_of(spark, [(None, text), (1, text), (1, text), (1, "x")])).collect()
    assert sorted((r.doc_id or -1, len(r.licences)) for r in rows) == [(-1, 1), (1, 0), (1, 1), (1, 1)]
    assert find_licences(docs_of(spark, ["a"]).where("false")).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op9_license_scan(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for name in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"):
        assert name not in plan


@pytest.mark.parametrize("width, mark", [(60, ""), (70, "# "), (80, " * "), (66, "// ")])
def test_wrapped_notices_are_confirmed(spark, width, mark):
    rng = random.Random(2)
    prose = lambda: " ".join(rng.choice(WORDS[:3] + WORDS[-3:]) for _ in range(9))
    pairs = [(f, n) for f, list_ in NOTICES.items() for n in list_]
    texts = ["\n".join([prose(), *(mark + line for line in textwrap.wrap(n, width)), prose()]) for _, n in pairs]
    texts += ["\n".join(["the license of the public software", prose(), "copyright and version terms", prose()])] * 3
    rows = {r.doc_id: r for r in find_licences(docs_of(spark, texts)).collect()}
    for i, (family, _) in enumerate(pairs):
        assert [x.family for x in rows[i].licences if x.confirmed] == [family], texts[i]
    assert all(not any(x.confirmed for x in rows[i].licences) for i in range(len(pairs), len(texts)))


def test_the_sample_does_not_depend_on_splits(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    from lutrin.llm.licences import training_rows

    samples = [sorted(map(str, training_rows(spark, docs.repartition(n), "text", 50).collect())) for n in (1, 5)]
    assert samples[0] == samples[1]


def test_prose_about_licences_calibrates_the_unknown_class(spark):
    """Sentences full of cue words, of which no template is made: held out, they lift the threshold above themselves."""
    rng = random.Random(5)
    parts = ["the general public license", "licensed under the terms", "version 3 of the gnu", "free software license", "creative commons", "copyright of the authors"]
    prose = lambda: " ".join(rng.choice(WORDS[:3] + WORDS[-3:]) for _ in range(12))
    talk = lambda: " ".join(f"{rng.choice(parts)} {rng.choice(WORDS)}" for _ in range(4))
    texts = ["\n".join([prose(), talk(), prose()]) for _ in range(150)]
    notices = [(f, n) for f, list_ in NOTICES.items() for n in list_]
    texts += ["\n".join([prose(), n, prose()]) for _, n in notices]
    rows = {r.doc_id: r for r in find_licences(docs_of(spark, texts)).collect()}
    threshold = rows[0].threshold
    assert LIKELY < threshold <= 0.99
    assert not any(x.confirmed for i in range(150) for x in rows[i].licences)
    # every row is in the sample with its one line of cue words, so none exceeds what it was calibrated on
    if threshold < 0.99:
        assert not any(rows[i].licences for i in range(150))
    for i, (family, _) in enumerate(notices):  # confirmed notices do not depend on the threshold
        assert [x.family for x in rows[150 + i].licences if x.confirmed] == [family]


def test_every_paragraph_is_learned_from_or_held_out(spark):
    """Counts of all paragraphs with words, however many a row has; those of a template's text are left out."""
    rng = random.Random(7)
    prose = lambda: " ".join(rng.choice(WORDS) + str(rng.randrange(3)) for _ in range(6))
    texts = ["\n".join([prose(), "the license of a house", prose(), "", "about copyright", prose()]) for _ in range(40)]
    texts += ["\n".join(["...", NOTICES["MIT"][0]]), "", None]
    rows = training_rows(spark, docs_of(spark, texts, clashes=True), "text").where("sampled").collect()
    assert {r.label for r in rows} == {"unknown"}
    assert sum(r.n for r in rows) == 40 * 5
    assert sum(r.n for r in rows if {"license", "copyright"} & set(r.words)) == 80
    assert all(r.held for r in rows if {"license", "copyright"} & set(r.words))
    assert 0 < sum(r.n for r in rows if r.held) - 80 < 60


def test_the_threshold_knows_all_paragraphs(spark):
    """Misleading lines behind another one with cue words, all in one row of many, lift the threshold."""
    rng = random.Random(5)
    parts = ["the general public license", "licensed under the terms", "version 3 of the gnu", "free software license", "creative commons", "copyright of the authors"]
    talk = [" ".join(f"{rng.choice(parts)} {rng.choice(WORDS)}" for _ in range(4)) for _ in range(40)]
    lines = ["a license is no notice", *(line for t in talk for line in ["", "", "", "", "", "", "", "", t])]
    texts = [*(f"plain words {i}" for i in range(100)), "\n".join(lines)]
    assert find_licences(docs_of(spark, texts)).first().threshold > LIKELY
