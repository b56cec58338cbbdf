"""Each operator against a brute-force version, a round trip or held-out labels, and on odd rows."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from statistics import NormalDist

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stratalake.llm import (
    components, decontamination, encoder, forest, packing, pii, quality, queries, repeats, shingle_join, site_lines,
    token_files, toxicity,
)

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "a  b", "\n\nx ", "word", "naïve, café!!\tx", "don't 12,3 <|endoftext|> 日本", "z" * 5000, "the cat sat on the mat " * 400]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, keys string, host string, part int"


def frame(spark, texts, source="src"):
    rows = [(i, t, "en", source, len(t or ""), "r", "k", "h", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_equals_whole_text(path, texts):
    own, plain = encoder.Encoder(path), Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    for text in [*texts.values(), *(t or "" for t in ODD), "É́a é", "ﬁ ΑΣ Σ. İ", "--x --", "a\x1cb \x1c c", "'s 's. it's.", "A.B. c,,", "\xa0a \xa0 b"]:
        assert own.encode(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_pack_covers_every_id(spark, texts):
    rows = packing.sequence_numbers(packing.pack(frame(spark, [*ODD, "x y z", "x y z"]), WORDS, longest=64)).collect()
    own = encoder.Encoder(WORDS)
    ids = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == len(ids[r.doc_id]) and r.length == len(r.ids) and r.offset == 0
        assert r.length & (r.length - 1) == 0 and r.length <= 64
        ids[r.doc_id] += r.ids
    for i, text in enumerate([*ODD, "x y z", "x y z"]):
        assert np.array(ids[i], "<u4").tobytes() == own.encode(text or "") + b"\1\0\0\0"
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    by_id = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert by_id == sorted(by_id)


def test_token_files_round_trip(spark, scratch):
    token_files.write_token_files(frame(spark, ODD).repartition(3), scratch + "/t", BYTES)
    rows = token_files.token_starts(packing.with_crc(token_files.read_tokens(spark, scratch + "/t"))).orderBy("doc_id").collect()
    own, start = encoder.Encoder(BYTES), 0
    for r, text in zip(rows, ODD, strict=True):
        ids = own.encode(text or "") + b"\0\0\0\0"
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        start += r.n_tokens


def test_tables_index_every_bin():
    x = np.random.default_rng(1).normal(size=(3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit_tables(x, y, np.ones(len(x)))
    assert (0, 1) in model.pairs
    assert (((model.score(x) > 0.5) == (y == 1)).mean()) > 0.9


@pytest.mark.parametrize("name, label, threshold", [("op1_quality_gam", "quality", 0.7), ("op6_toxicity_nearest", "toxic", 0.3)])
def test_classifiers_on_held_out_rows(spark, name, label, threshold):
    folder = "/root/testdata/sf0.1"
    rows = queries.QUERIES[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in rows)
    assert np.mean([r.predicted == r[label] for r in rows]) > 0.95
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)


def test_block_max_is_exact():
    random = np.random.default_rng(5)
    vectors = []
    for _ in range(400):
        terms = random.choice(30, random.integers(1, 8), replace=False)
        w = random.random(len(terms))
        vectors.append(dict(zip(terms.tolist(), (w / np.sqrt((w * w).sum())).tolist())))
    index = toxicity.BlockMaxIndex(vectors, 30)
    for q in vectors[:60]:
        exact = sorted(((sum(w * v.get(t, 0) for t, w in q.items()), -i) for i, v in enumerate(vectors)), reverse=True)
        want = [s for s, _ in exact if s > 0][:10]
        assert np.allclose([s for s, _ in index.nearest(q, 10)], want)


def test_rare_toxic_words_have_neighbours(spark):
    pick = random.Random(8)
    common = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = [" ".join(pick.choices(common, k=30)) for _ in range(300)]
    rows += [" ".join([*pick.choices(common, k=30), "vilest" if i < 60 else f"slur{chr(97 + i % 10)}"]) for i in range(100)]
    asked = [" ".join([*pick.choices(common, k=30), x]) for x in ("slurc", "slurc", "slurd", "sunny", "sunny")]
    docs = frame(spark, [*rows, *asked])
    labels = spark.createDataFrame([(i, int(i >= 300)) for i in range(len(rows))], "doc_id long, toxic int")
    scores = toxicity.score_toxicity(docs, toxicity.fit(docs, labels)).filter(f"row.doc_id >= {len(rows)}").orderBy("row.doc_id")
    scores = [r.score for r in scores.collect()]
    assert min(scores[:3]) >= toxicity.THRESHOLD > max(scores[3:])


def test_plain_spans_follow_the_patterns(texts):
    for text in [*texts.values(), "a@b.co 1.2.3.400 4111 1111 1111 1111, +1 (988) 555-2485"]:
        want = [(m.start(), "email", m.end()) for m in pii.EMAIL.finditer(text)]
        want += [(m.start(), "ip", m.end()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        for m in pii.CARD.finditer(text):
            d = [int(c) for c in m.group() if c.isdigit()][::-1]
            total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d))
            if 14 <= len(d) <= 19 and total % 10 == 0:
                want.append((m.start(), "card", m.end()))
        want += [(m.start(), "phone", m.end()) for m in pii.PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
        assert pii.spans(text)[0] == sorted(want, key=lambda x: (x[0], pii.KINDS.index(x[1])))


@pytest.mark.parametrize("text, kind, span", [
    ("ask john at example dot com now", "email", "john at example dot com"),
    ("x jоhn@exаmple.com y", "email", "jоhn@exаmple.com"),
    ("mail john [at] example [dot] com", "email", "john [at] example [dot] com"),
    ("call plus one five five five one two three four five six seven.", "phone", "plus one five five five one two three four five six seven"),
    ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("x 192[.]168[.]1[.]10", "ip", "192[.]168[.]1[.]10"),
    ("card 4l11 1111 1111 1111", "card", "4l11 1111 1111 1111"),
    ("192 dot 168 dot 1 dot 10", "ip", "192 dot 168 dot 1 dot 10"),
])
def test_disguises_map_back(text, kind, span):
    assert [(k, text[a:b]) for a, k, b in pii.spans(text)[1]] == [(kind, span)]


@pytest.mark.parametrize("text, kind, plain, whole", [
    ("x jоhn@example.com y", "email", "hn@example.com", "jоhn@example.com"),
    ("jo\u200bhn@example.com", "email", "hn@example.com", "jo\u200bhn@example.com"),
    ("ｊohn@example.com", "email", "ohn@example.com", "ｊohn@example.com"),
    ("first [dot] last@example.com", "email", "last@example.com", "first [dot] last@example.com"),
    ("call +1 988 555 2485 plus +1 988 555 248５", "phone", "+1 988 555 2485", "+1 988 555 248５"),
])
def test_disguised_part_beside_a_plain_one(text, kind, plain, whole):
    base, every = pii.spans(text)
    assert [(k, text[a:b]) for a, k, b in base if k == kind][0] == (kind, plain)
    assert set(base) < set(every) and (kind, whole) in {(k, text[a:b]) for a, k, b in every}


def test_plain_identifiers_are_not_added_again():
    for text in ("ask john@example.com or one of us", "plus one john@example.com dot", "оne 192.168.1.10"):
        base, every = pii.spans(text)
        assert base == every and len(base) == 1


def test_cues_hide_no_rewrite(texts):
    bits = ["one", "dot", "at", "@", "(at)", "[.]", ".", "john", "com", "oh", "plus", "4l11", "5o5", "1111", "[", " )", "-", "\n", "\u200b", "о", "seven"]
    pick = random.Random(3)
    made = ["".join(x + pick.choice(["", " ", "\n"]) for x in pick.choices(bits, k=pick.randint(2, 12))) for _ in range(4000)]
    for text in [*texts.values(), *made]:
        signs, place = pii._letters(text)
        plain = pii.Normalised(text)
        assert plain.text == pii.DISGUISES.sub(pii._rewrite, signs)
        spans = [s for m in pii.DISGUISES.finditer(signs) for s in [m.span()] * len(pii._rewrite(m))]
        inside = {i for a, b in spans for i in range(a, b)}
        kept = [(i, i + 1) for i in range(len(signs)) if i not in inside]
        want = sorted([*kept, *spans])
        assert [plain.source(i, i + 1) for i in range(len(plain.text))] == [(place[a], place[b - 1] + 1) for a, b in want]
        assert not plain.text or plain.source(0, len(plain.text)) == (place[0], place[-1] + 1)


def test_clean_prose_has_no_spans(texts):
    for text in ("We met at the office. There was one dot on it.", "Zwei Äpfel à la carte, at noon.", "look at this.Then go"):
        assert pii.spans(text)[1] == []


def test_leaks_with_other_values(spark):
    item = "a train leaves the old station at 300 km with 12 boxes and Maria counts 300 boxes before the long bridge"
    benchmark = spark.createDataFrame([(7, item), (8, None), (9, "short")], "item_id long, text string")
    cases = [
        f"Before. {item} After that.", item.replace("300", "450").replace("12", "7").replace("Maria", "Peter"),
        item.replace("300 km", "450 km"), "nothing of the kind here at all in this text, only plain words of no note", None, "",
    ]
    rows = {r.doc_id: r for r in decontamination.leaks(frame(spark, cases), benchmark).collect()}
    assert rows[0].same_values and rows[0].n_found >= rows[0].n_windows - 2
    assert not rows[1].same_values and rows[1].item_id == 7
    assert set(rows) <= {0, 1, 2} and (2 not in rows or rows[2].n_found < rows[0].n_found)
    kept = decontamination.drop_leaks(frame(spark, cases), benchmark)
    assert kept.columns == frame(spark, cases).columns and {3, 4, 5} <= {r.doc_id for r in kept.collect()}
    assert decontamination.leaks(frame(spark, cases), benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("item, text, least", [
    ("the shop sells 300 big red apples and then 300 more to us", "the shop sells 300 big red apples and then 450 more to us", 1),
    ("the girl has 3 apples and her brother has 5 pears in all", "the girl has 4 apples and her brother has 4 pears in all", 5),
    ("they carry 2 boxes of 2 big red balls up the long stairs", "they carry 3 boxes of 5 big red balls up the long stairs", 1),
    ("they sell 300 to us now and 300 more", "they sell 300 to us now and 450 more", 0),
])
def test_leaks_whose_values_are_not_one_to_one(spark, item, text, least):
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    rows = {r.doc_id: r for r in decontamination.leaks(frame(spark, [text, item, f"{text} {text}"]), benchmark).collect()}
    assert set(rows) == {0, 1, 2}
    assert least <= rows[0].n_found <= rows[0].n_windows and not rows[0].same_values
    assert rows[1].n_found == rows[1].n_windows and rows[1].same_values


def test_leaks_of_short_long_and_lower_cased_items(spark):
    long = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    names = "Anna and Peter see Maria near Paul while Otto and Hans follow Emma to Rome with Karl"
    items = ["What is 17 plus 25", "12 7 19 33 41 58 63 70 82 91", "Anna Peter Maria Paul", " ".join(long), names]
    texts = [
        "He asked: what is 17 plus 25? Then", "so 12 7 19 33 41 58 63 70 82 91 and", "x Anna, Peter, Maria, Paul.",
        "Before " + " ".join(long[100:190]) + " after", "I saw " + names.lower() + " there",
        "what is 17 plus", "12 7 19 33", "anna peter and maria paul", " ".join(long[:20]), "anna and peter see maria", None, "",
    ]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = decontamination.leaks(frame(spark, texts), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(i, i) for i in range(5)}
    assert all(r.same_values and 0 < r.n_found <= r.n_windows for r in rows)
    kept = decontamination.drop_leaks(frame(spark, texts), benchmark).collect()
    assert {r.doc_id for r in kept} == set(range(5, 12))


def test_groups_equal_brute_force(spark, docs, texts):
    sets, lists = {}, defaultdict(list)
    for i, text in texts.items():
        w = [x.lower() if x.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text)]
        sets[i] = {tuple(w[a : a + 4]) for a in range(len(w) - 3)} if len(w) > 3 else ({tuple(w)} if w else set())
        for s in sets[i]:
            lists[s].append(i)
    least = {i: i for i in sets}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in lists[x] if j < i).items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                least[b] = a
    for r in shingle_join.similar_groups(docs).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root(r.doc_id))


def test_near_copies_form_one_group(spark):
    random = np.random.default_rng(3)
    base = [f"w{x}" for x in random.integers(0, 5000, 300)]
    near = []
    for k in range(40):
        words = list(base)
        words[int(random.integers(0, 300))] = f"edit{k}"
        near.append(" ".join(words))
    cases = [*near, near[0], near[0].upper(), None, "", "one two", "ONE  two"]
    rows = {r.doc_id: r for r in shingle_join.similar_groups(frame(spark, cases)).collect()}
    assert {rows[i].component_id for i in range(42)} == {0}
    assert [rows[i].component_id for i in (42, 43, 44, 45)] == [42, 43, 44, 44]
    assert [rows[i].n_shingles for i in (42, 43, 44)] == [0, 0, 1]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(500)] + [(9000, 8000), (8000, 9000)], "a long, b long").repartition(7)
    found = {r.a: r.b for r in components.components(links).collect()}
    assert found == {**{i: 0 for i in range(1, 501)}, 9000: 8000}
    assert components.components(links.limit(0)).count() == 0


def brute_repeats(rows, length):
    seen = Counter(x[a : a + length] for x in rows for a in range(len(x) - length + 1))
    for x in rows:
        gone = bytearray(len(x))
        for a in range(len(x) - length + 1):
            if seen[x[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        yield len(x), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(c for c, g in zip(x, gone) if not g)


def test_repeats_equal_brute_force(spark, texts):
    some = list(texts.values())[:60]
    passage = some[0][:700]
    cases = [*some, *ODD, passage + some[1], some[2][:300] + passage + some[2][300:], "ab" * 1000, "ü" * 450]
    got = {r.doc_id: r for r in repeats.remove_repeats(frame(spark, cases)).collect()}
    for i, want in enumerate(brute_repeats([(t or "").encode() for t in cases], 400)):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == want


def test_forest_recall_and_order(spark, folder):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = defaultdict(list)
    for r in sorted(queries.QUERIES["op8_forest_neighbours"](spark, "/root/testdata/sf0.1").collect()):
        found[r.query_id].append(r)
    hits = total = 0
    for q, near in found.items():
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = np.lexsort((ids, d))[:10]
        assert [r.rank for r in near] == list(range(1, 11))
        assert all(r.score == d[ids == r.vec_id][0] for r in near)
        assert [(r.score, r.vec_id) for r in near] == sorted((r.score, r.vec_id) for r in near)
        hits += len({r.vec_id for r in near} & set(ids[best].tolist()))
        total += 10
    assert len(found) == (ids % 100 == 0).sum() and hits / total >= 0.9


def test_forest_leaves_out_what_has_no_place(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]), (7, []), (2, [0.0, 2.0]), (None, [1.0, 1.0]), (100, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F

    found = [tuple(r) for r in forest.nearest(vectors, F.col("vec_id") % 100 == 0).orderBy("rank").collect()]
    assert found == [(0, 1, 1, 0.0), (0, 2, 2, 2**0.5)]
    assert forest.nearest(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_site_lines_by_host(spark):
    texts = [f"menu \nown line {i}\n\n{'note' if i < 2 else f'n{i}'}" for i in range(20)] + [None, "", "menu"]
    rows = {r.row.doc_id: r for r in site_lines.drop_site_lines(frame(spark, texts)).collect()}
    assert rows[0].row.text == "own line 0\n\nnote" and rows[0].n_dropped == 1 and rows[0].row.n_chars == 16
    assert rows[20].row.text is None and rows[21].row.text == "" and rows[22].row.text == ""
    lone = site_lines.drop_site_lines(frame(spark, ["menu", "menu"], None)).collect()
    assert [r.row.text for r in lone] == ["menu", "menu"]


@pytest.mark.parametrize("apply", [
    lambda d: packing.pack(d, WORDS), lambda d: pii.find_personal_data(d), lambda d: repeats.remove_repeats(d),
    lambda d: shingle_join.similar_groups(d), lambda d: site_lines.drop_site_lines(d),
])
def test_empty_tables(spark, apply):
    assert apply(frame(spark, ["x"]).limit(0)).count() == 0


def test_models_without_labels(spark):
    rows, labels = frame(spark, ODD), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scores = toxicity.score_toxicity(rows, toxicity.fit(rows, labels)).collect()
    assert [r.score for r in scores] == [0.0] * len(ODD)
    assert {r.score for r in quality.score_quality(rows, quality.fit(rows, labels)).collect()} == {0.5}


def test_toxicity_scores_by_brute_force(spark):
    pick = random.Random(12)
    plain = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    made = [" ".join(pick.choices(plain, k=pick.randrange(5, 40)) + pick.choices(["vile", "scum", "ugh"], k=3) * (i % 4 == 0)) for i in range(260)]
    rare = [i for i in range(0, 200, 4) if zlib.crc32(str(i).encode()) % 4 != 2][:3] + [204]
    for i in rare:
        made[i] = " ".join([*pick.choices(plain, k=6), "grub"])
    made += [made[0], made[1], "", None, "vile", "only new ones here"]
    docs = frame(spark, made).repartition(5)
    told = [(i, int(i % 4 == 0)) for i in range(200)]
    model = toxicity.fit(docs, spark.createDataFrame(told, "doc_id long, toxic int"))
    got = {r.row.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    train = [(i, y) for i, y in told if zlib.crc32(str(i).encode()) % 4 != 2]
    counts = [Counter((t or "").lower().split()) for t in made]
    n = [sum(y == c for _, y in train) for c in (0, 1)]
    words = {w for i, _ in train for w in counts[i]}
    least = NormalDist().inv_cdf(1 - 1 / len(words) / 2) ** 2
    weights = [{}, {}]
    for w in words:
        a, b = (sum(w in counts[i] for i, y in train if y == c) for c in (1, 0))
        apart = max(abs(a * (n[0] - b) - b * (n[1] - a)) - sum(n) / 2, 0)
        rest = (a + b) * (sum(n) - a - b) * n[0] * n[1]
        square = sum(n) * apart**2 / rest if rest else 0
        if square > least or square > toxicity.CHANCE and a > b:
            weights[square <= least][w] = np.log((1 + len(made)) / (1 + sum(w in c for c in counts))) + 1

    def vector(c, tier):
        v = {w: (1 + np.log(k)) * weights[tier][w] for w, k in c.items() if w in weights[tier]}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    held = [[(i, vector(counts[i], t), y) for i, y in train if vector(counts[i], t)] for t in (0, 1)]
    for t in (0, 1):
        assert weights[t] and set(weights[t]) == {w.decode() for w in model.tiers[t].term} and len(held[t]) == len(model.tiers[t].docs)
    assert any(vector(c, 1) and not vector(c, 0) for c in counts)
    for i, c in enumerate(counts):
        tier = next((t for t in (0, 1) if vector(c, t)), 0)
        q, known = vector(c, tier), held[tier]
        near = sorted((sum(x * v.get(w, 0.0) for w, x in q.items()) for _, v, y in known), reverse=True)[: toxicity.NEAREST]
        border = near[-1] if near else 0.0
        near = [(x, y) for (x, y) in ((sum(x * v.get(w, 0.0) for w, x in q.items()), y) for _, v, y in known) if x > max(border, 0.0) + 1e-9]
        tied = [y for y, s in ((y, sum(x * v.get(w, 0.0) for w, x in q.items())) for _, v, y in known) if abs(s - border) <= 1e-9 and s > 0]
        left = toxicity.NEAREST - len(near)
        base = n[1] / sum(n)

        def score(toxic_ties):
            votes = sum(x * x * y for x, y in near) + toxic_ties * border**2
            every = sum(x * x for x, _ in near) + min(left, len(tied)) * border**2
            return (votes + toxicity.BASE_WEIGHTS[tier] * base) / (every + toxicity.BASE_WEIGHTS[tier])

        take = min(left, len(tied))
        low, high = max(0, take - tied.count(0)), min(take, tied.count(1))
        assert score(low) - 1e-9 <= got[i].score <= score(high) + 1e-9


def test_words_of_a_sample_or_of_copies_alone_do_not_tell(spark):
    pick = random.Random(3)
    common = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    rows = [" ".join(pick.choices(common, k=30)) for _ in range(1200)]
    rows += [" ".join([*pick.choices(common, k=30), "vilest"]) for _ in range(60)]
    rows += [" ".join([*pick.sample(common, 40), "vilest"])] * 40
    docs, first = frame(spark, rows), 1200
    labels = spark.createDataFrame([(i, int(i >= first)) for i in range(len(rows))], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, each=120)
    assert {w for tier in model.tiers for w in tier.term} == {b"vilest"}
    rejected = {r.row.doc_id for r in toxicity.score_toxicity(docs, model).collect() if r.score >= toxicity.THRESHOLD}
    assert rejected == set(range(first, len(rows)))


def test_toxicity_keeps_every_different_example(spark):
    texts = [f"same longer words {'abcdefghij'[i % 10]}x bad" if i % 2 else f"fine text {'abcdefghij'[i % 10]}y" for i in range(80)]
    model = toxicity.fit(frame(spark, texts), spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int"))
    assert len(model.docs) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(80))


def test_spans_of_long_runs_take_linear_time():
    n = 1_000_000
    cases = ["7" * n, "a" * n + " x@y.zz", "a" * n + "@", "x" + " " * n + "(at) y", "\n" * n + "one", "1." * (n // 2), "a@" * (n // 2), "+1" + " " * n, "4 " * (n // 2), "." * n + "@b.c"]
    for text in cases:
        start = time.perf_counter()
        pii.spans(text)
        assert time.perf_counter() - start < 4, text[:20]
    base, every = pii.spans("mail john" + " " * 5000 + "(at)\n\n\nexample" + "\t" * 700 + "dot" + "  " * 90 + "com now")
    assert base == [] and every == [(5, "email", 9 + 5000 + 4 + 3 + 7 + 700 + 3 + 180 + 3)]


def test_rewrites_between_any_blanks_are_those_of_the_pattern():
    bits = ["one", "dot", "at", "@", "(at)", "[.]", ".", "john", "com", "oh", "plus", "5o5", "[", " )", "-", "  ", "\n\n", "   ", "\t", " ", ",", "seven", "a.com"]
    pick = random.Random(9)
    for _ in range(20_000):
        text = "".join(pick.choices(bits, k=pick.randint(2, 14)))
        assert list(pii._rewrites(text)) == [(*m.span(), pii._rewrite(m)) for m in pii.DISGUISES.finditer(text)]


def test_emails_and_ips_are_those_of_the_patterns():
    pick = random.Random(10)
    for _ in range(20_000):
        text = "".join(pick.choices("a.@-1 +b", k=pick.randint(1, 24)))
        assert list(pii._emails(text)) == [m.span() for m in pii.EMAIL.finditer(text)]
        text = "".join(pick.choices("12. a", k=pick.randint(1, 24)))
        assert [m.span() for m in pii._IP_RUNS.finditer(text)] == [m.span() for m in pii.IP.finditer(text)]


def test_leaks_need_consistent_slots(spark):
    item = "then Tom gave the old box to Tom while young Ann took 3 red balls and 3 blue balls and 3 more from the shelf"
    values = [("Tom", "Tom", "Ann", "3", "3", "3"), ("Max", "Max", "Eva", "8", "8", "8"), ("Tom", "Bob", "Eve", "4", "9", "1"), ("Max", "Max", "Eva", "8", "8", "9")]
    texts = ["then {} gave the old box to {} while young {} took {} red balls and {} blue balls and {} more from the shelf".format(*v) for v in values]
    assert texts[0] == item
    rows = {r.doc_id: r for r in decontamination.leaks(frame(spark, texts), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    n = rows[0].n_windows
    assert rows[0].n_found == rows[1].n_found == n and rows[0].same_values and not rows[1].same_values
    assert 2 not in rows and 0 < rows[3].n_found < n


def test_short_items_are_reported_but_remove_nothing(spark):
    benchmark = spark.createDataFrame([(1, "yes"), (2, "Paris"), (3, "What is 17 plus 25")], "item_id long, text string")
    docs = frame(spark, ["yes we were in Paris", "what is 17 plus 25", "no"])
    found = {(r.doc_id, r.item_id, r.n_words) for r in decontamination.leaks(docs, benchmark).collect()}
    assert found == {(0, 1, 1), (0, 2, 1), (1, 3, 5)}
    assert {r.doc_id for r in decontamination.drop_leaks(docs, benchmark).collect()} == {0, 2}
