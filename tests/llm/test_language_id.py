import numpy as np
import pyarrow as pa

from oreflow.llm import language_id
from oreflow.llm.language_id import DIMENSIONS, identify_languages, predict_language, train_prototypes, trigram_vectors

SCHEMA = "doc_id long, text string, lang string"
SYLLABLES = {"en": ["the", "er", "th", "ing", "and"], "es": ["ción", "ñ", "os", "ra", "el"], "de": ["ü", "sch", "ung", "ß", "ein"]}


def rows(n=240):
    rng = np.random.default_rng(2)
    out = []
    for i in range(n):
        lang = list(SYLLABLES)[i % 3]
        words = ["".join(rng.choice(SYLLABLES[lang], 2)) for _ in range(int(rng.integers(3, 60)))]
        out.append((i, " ".join(words).capitalize(), lang))
    return out


def brute_vector(text):
    letters = [ord(c.lower()) if c.isalpha() else 0 for c in f" {text} "]
    letters = [c for i, c in enumerate(letters) if i == 0 or c or letters[i - 1]]
    total = np.zeros(DIMENSIONS, np.int64)
    for i in range(len(letters) - 2):
        if any(letters[i : i + 3]):
            total += trigram_vectors(np.array([letters[i : i + 3]]))[0]
    return total


def test_held_out_accuracy_and_cosines(spark):
    data = rows()
    odd = [(900, None, "en"), (901, "", "es"), (902, "12 !! 34", "de"), (None, "sch ung ein", "en"), (903, "the and", None), (904, "日本語", None)]
    docs = spark.createDataFrame(data + odd, SCHEMA).repartition(4)
    found = {r["doc_id"]: r for r in identify_languages(docs).collect()}
    assert len(found) == len(data) + len(odd)
    for i in (900, 901, 902):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    held = [(found[i]["lang_pred"], lang) for i, _, lang in data if found[i]["held_out"]]
    assert len(held) > 20 and all(a == b for a, b in held)
    prototypes = train_prototypes(docs)
    learnt = {lang: sum(brute_vector(t) for i, t, x in data if x == lang and not found[i]["held_out"]) for lang in SYLLABLES}
    for lang, vector in learnt.items():
        assert (prototypes[lang] == vector).all()
    for i, text, _ in data[:20]:
        mine = brute_vector(text)
        cosines = {x: mine @ v / np.linalg.norm(mine) / np.linalg.norm(v) for x, v in learnt.items()}
        best = max(cosines, key=cosines.get)
        assert found[i]["lang_pred"] == best and abs(found[i]["score"] - cosines[best]) < 1e-5


def test_lang_and_id_of_a_row_do_not_count(spark):
    data = rows(60)
    prototypes = train_prototypes(spark.createDataFrame(data, SCHEMA))
    moved = spark.createDataFrame([(i + 1000, t, "xx") for i, t, _ in data] + [(7, data[0][1], None)] * 2, SCHEMA)
    found = predict_language(moved, prototypes, keys=("doc_id", "text", "lang")).collect()
    want = {t: r["lang_pred"] for (_, t, _), r in zip(data, sorted(predict_language(spark.createDataFrame(data, SCHEMA), prototypes).collect(), key=lambda r: r["doc_id"]))}
    assert all(r["lang_pred"] == want[r["text"]] for r in found) and len(found) == 62


def test_learns_nothing_from_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert identify_languages(none).count() == 0
    odd = spark.createDataFrame([(1, "abc", None, "x")], SCHEMA + ", score string")
    assert [tuple(r)[2:] for r in identify_languages(odd).collect()] == [("und", 0.0)]


def test_vectors_of_many_trigrams_are_not_held_at_once(monkeypatch):
    rng, sizes, whole = np.random.default_rng(4), [], language_id.trigram_vectors
    texts = ["".join(chr(c) for c in rng.integers(0x4E00, 0x5E00, 2500)) for _ in range(4)]
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "a", "b", "b"], "text": texts})

    def noted(trigrams, dimensions):
        sizes.append(len(trigrams))
        return whole(trigrams, dimensions)

    monkeypatch.setattr(language_id, "trigram_vectors", noted)
    (found,) = language_id._bundle([batch], 128)
    assert max(sizes) <= 2048 < sum(sizes)
    sums = {r["lang"]: np.array(r["bundle"]) for r in found.to_pylist()}
    for lang, own in (("a", texts[:2]), ("b", texts[2:])):
        trigrams = [[ord(c) if c != " " else 0 for c in f" {t} "[i : i + 3]] for t in own for i in range(len(t))]
        assert (sums[lang] == whole(np.array(trigrams), 128).sum(axis=0, dtype=np.int64)).all()
