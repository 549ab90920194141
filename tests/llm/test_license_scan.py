import random

import pytest
from pyspark.sql import functions as F

from tests.llm.samples import empty_docs, hard_docs, hard_rows, prose
from timeward.llm import license_scan as scan
from timeward.llm.queries import op11_suffix_automaton_licenses

SMALL = scan.Library(
    phrases=(("a b", "ab"), ("b", "b"), ("b c a b", "long")),
    templates=(("one", "a b c a b d a b c e f g a b c d"), ("two", "c a b d x y a b c a b d"), ("three", "g g a b g")),
    least=3,
    gap=4,
)


def _words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c if c > "\x7f" or c in "0123456789" or "a" <= c <= "z" else " " for c in text or "").split(" ")


def _plain_words(text):
    return [w for w in _words(text) if w]


def _sequences(library):
    return [p.split() for p, _ in library.phrases] + [t.split() for _, t in library.templates]


def _longest(words, end, sequences):
    """The longest run of words ending before ``end`` that stands in a sequence."""
    best = 0
    for s in sequences:
        for e in range(1, len(s) + 1):
            n = 0
            while n < min(e, end) and s[e - 1 - n] == words[end - 1 - n]:
                n += 1
            best = max(best, n)
    return best


def _places(words, library):
    phrases = [p.split() for p, _ in library.phrases]
    return sorted((i, n) for n, p in enumerate(phrases) for i in range(len(words)) if words[i : i + len(p)] == p)


@pytest.mark.parametrize("seed", range(8))
def test_matching_statistics_against_brute_force(seed):
    r = random.Random(seed)
    words = [r.choice("aaabbbccdefgxyz") for _ in range(200)]
    s = scan.Scanner(SMALL)
    found = {place: run for place, run, _ in s.statistics([w.encode() for w in words])}
    sequences = _sequences(SMALL)
    assert [found.get(k, 0) for k in range(200)] == [_longest(words, k + 1, sequences) for k in range(200)]


@pytest.mark.parametrize("seed", range(8))
def test_states_know_all_places_of_their_runs(seed):
    r = random.Random(seed)
    words = [r.choice("abcd") for _ in range(120)]
    s = scan.Scanner(SMALL)
    sequences = _sequences(SMALL)
    for place, run, state in s.statistics([w.encode() for w in words]):
        tail = words[place + 1 - run : place + 1]
        expected = [(n, e) for n, q in enumerate(sequences) for e in range(run, len(q) + 1) if q[e - run : e] == tail]
        assert list(s.automaton.ends[state]) == expected


@pytest.mark.parametrize("seed", range(12))
def test_phrases_and_matches_against_brute_force(seed):
    r = random.Random(100 + seed)
    words = [r.choice("aabbccdg") for _ in range(150)]
    s = scan.Scanner(SMALL)
    places, matches = s.scan([w.encode() for w in words])
    assert places == _places(words, SMALL)
    # Matches: longest runs that the next word does not prolong.
    sequences, expected = _sequences(SMALL), set()
    longest = [_longest(words, k, sequences) for k in range(1, len(words) + 1)]
    for k, run in enumerate(longest):
        if run >= SMALL.least and (k + 1 == len(words) or longest[k + 1] != run + 1):
            tail = words[k + 1 - run : k + 1]
            for n, q in enumerate(sequences[3:], 3):
                expected |= {(n, k + 1 - run, k + 1, e - run) for e in range(run, len(q) + 1) if q[e - run : e] == tail}
    assert {(n, *m) for n, found in matches.items() for m in found} == expected


@pytest.mark.parametrize("seed", range(12))
def test_chain_covers_as_much_as_the_best_of_all_subsets(seed):
    import itertools

    r = random.Random(seed)
    runs = sorted({(a, a + n, b) for a, n, b in ((r.randrange(30), r.randrange(3, 7), r.randrange(20)) for _ in range(8))}, key=lambda m: (m[1], m[2]))
    s = scan.Scanner(SMALL)

    def covered(chain):
        total = 0
        for k, (start, end, at) in enumerate(chain):
            gain = end - start
            if k:
                p = chain[k - 1]
                overlap = max(p[1] - start, p[2] + p[1] - p[0] - at, 0)
                if overlap >= gain or p[0] > start or p[2] > at or p[1] < start - SMALL.gap:
                    return 0
                gain -= overlap
            total += gain
        return total

    best = max(covered(c) for k in range(1, len(runs) + 1) for c in itertools.combinations(runs, k))
    assert max(c for *_, c in s.chains({3: list(runs)})) == best


def _text(label):
    return dict(scan.TEMPLATES)[label]


def test_labels_of_whole_partial_and_edited_texts(spark):
    mit, bsd3, bsd2 = _text("mit"), _text("bsd-3-clause"), _text("bsd-2-clause")
    edited = mit.replace("hereby ", "").replace("sublicense", "relicense").upper()
    half = " ".join(mit.split()[:95])
    little = " ".join(mit.split()[:30])
    rows = [
        (1, f"{prose(1, 50)} {mit}. {prose(2, 50)}", "mit"),
        (2, edited, "mit"),
        (3, half, "mit"),
        (4, little, ""),
        (5, bsd3.replace(" ", "\n * "), "bsd-3-clause"),
        (6, bsd2, "bsd-2-clause"),
        (7, prose(3, 400), ""),
        (8, f"{_text('apache')} {prose(4, 30)} {_text('isc')}", "apache,isc"),
        (9, "Released under the MIT License.", "mit"),
        (10, "CC-BY 4.0, or the GNU General\nPublic License", "cc-by,gpl"),
        (11, " ".join(reversed(mit.split())), ""),
        (12, (mit + " x ") * 300, "mit"),
        (13, f"Apachë License ápache license, {_text('mpl')}", "mpl"),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = scan.with_licenses(docs)
    got = found.select("doc_id", F.array_join(scan.labels(F.col("licenses")), ",").alias("labels"), scan.score(F.col("licenses")).alias("score"), "licenses.spans").collect()
    assert {r["doc_id"]: r["labels"] for r in got} == {r[0]: r[2] for r in rows}
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["score"] == 1.0 and [(s["start"], s["end"]) for s in by_id[1]["spans"] if s["label"] == "mit"] == [(50, 50 + len(mit.split()))]
    assert 0.8 < by_id[2]["score"] < 1.0 and 0 < by_id[4]["score"] < 0.5
    assert sum(s["label"] == "mit" and s["share"] == 1.0 for s in by_id[12]["spans"]) == 300


def test_hard_rows_and_clashing_names(spark):
    docs = hard_docs(spark).withColumn("licenses", F.lit(1)).withColumn("words", F.lit("x")).withColumn("places", F.lit(2))
    got = scan.with_licenses(docs)
    assert got.columns == [c for c in docs.columns]
    rows = got.collect()
    assert sorted((str(r["doc_id"]), r["licenses"]["n_words"]) for r in rows) == sorted((str(r[0]), len(_plain_words(r[1]))) for r in hard_rows())
    assert scan.with_licenses(empty_docs(spark)).collect() == []
    with pytest.raises(ValueError):
        scan.Scanner(scan.Library(phrases=(("...", "x"),)))


def test_query_base_columns_by_definition(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = [lab for _, lab in scan.PHRASES]
    found = op11_suffix_automaton_licenses(spark, folder).collect()
    assert len(found) == len(texts) and any(r["n_base"] for r in found)
    for r in found:
        words = _plain_words(texts[r["doc_id"]])
        places = _places(words, scan.Library())
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({labels[n] for _, n in places}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"]
        assert 0 <= r["score"] <= 1
