"""The registered queries against brute force on the smallest tables."""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tarmac.llm import crf_pii, jaccard_join, quartile_digest, spaced_seeds, trie_bpe
from tarmac.llm.passages import tuned_bands
from tarmac.llm.queries import tokenizer_path

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


@pytest.fixture(scope="module")
def texts():
    return dict(zip(*pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values(), strict=True))


def rows_of(spark, name):
    return {r.doc_id: r for r in contract.queries()[name](spark, FOLDER).collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_digest_of_texts_and_their_edits(spark, texts):
    found = rows_of(spark, "op1_quartile_digest")
    ids = sorted(texts)
    for here, after in zip(ids, ids[1:] + ids[:1], strict=True):
        own, other = texts[here] or "", texts[after] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + other[:half]
        r = found[here]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == quartile_digest.digest(own)
        assert r.edited_fingerprint == quartile_digest.digest(edited)
        assert 0 <= r.near_next <= 1 and r.near_edited == quartile_digest.likeness(r.fingerprint, r.edited_fingerprint)
    assert np.mean([r.near_edited > r.near_next for r in found.values()]) > 0.95


def test_jaccard_components(spark, texts):
    found = rows_of(spark, "op7_jaccard_join")
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == brute_components(texts)


@pytest.mark.parametrize("seed", range(4))
def test_cells_of_a_region_lose_no_link(seed):
    r = random.Random(seed)
    base = [r.sample(range(10**9), r.choice([40, 60, 100, 130])) for _ in range(6)]
    sets = []
    for _ in range(400):
        s = list(r.choice(base))
        for _ in range(r.randint(0, len(s) // 4)):
            s[r.randrange(len(s))] = r.randrange(10**9)
        sets.append(np.unique(np.array(s, np.uint64)))
    n = np.array([len(s) for s in sets])
    comp = np.array([i // 2 for i in range(len(sets))])
    a, b = jaccard_join.region_pairs(n, comp, [jaccard_join.parity_sketch(s) for s in sets])
    got = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
    plain = [set(s.tolist()) for s in sets]
    for y in range(len(sets)):
        for x in range(y):
            if comp[x] != comp[y] and jaccard_join.linked(len(plain[x] & plain[y]), n[x], n[y]):
                assert (x, y) in got


@pytest.mark.parametrize("seed", range(6))
def test_no_row_with_a_partner_is_left_out(seed):
    r = random.Random(seed)
    rows = sorted((r.randrange(12), r.randrange(20, 60), r.randrange(4), r.randrange(13)) for _ in range(80))
    region, n, comp, rank = (np.array(x, np.int64) for x in zip(*rows, strict=True))
    mask = jaccard_join._partnered(jaccard_join._runs([region]), n, rank, comp)
    for i in range(len(rows)):
        same = [j for j in range(len(rows)) if j != i and region[j] == region[i]]
        near = [j for j in same if comp[j] != comp[i] and 5 * min(n[i], n[j]) >= 4 * max(n[i], n[j])]
        early = [j for j in same if 9 * (rank[i] + rank[j]) <= n[i] + n[j]]
        assert mask[i] == (bool(near) and bool(early))
    assert len(jaccard_join._partnered(np.array([0]), n[:0], rank[:0], comp[:0])) == 0


def test_split_regions_give_the_same_components(spark, monkeypatch, documents):
    r = random.Random(3)
    base = [f"w{r.randrange(10**6)}" for _ in range(60)]
    texts = {}
    for i in range(120):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2])):
            w[r.randrange(60)] = f"v{r.randrange(10**6)}"
        texts[i] = " ".join(w)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    found = jaccard_join.jaccard_components(documents(list(texts.items()))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(texts)


def test_tokens_equal_the_library(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    own = trie_bpe.load(tokenizer_path())
    r = random.Random(5)
    odd = ["", "  ", "Hello  World, it's 42€ Σας ΑΣ <|endoftext|>x <|startoftext|>", "a" * 3000, "ab\x1ccd", "İI ﬁ ½ 😀😀"]
    odd += ["".join(r.choices("etaoinrsh ", k=200)) for _ in range(200)]
    odd += ["".join(chr(r.choice([r.randint(32, 126), r.randint(160, 900), r.randint(0x4E00, 0x4F00)])) for _ in range(60)) for _ in range(200)]
    for text, (ids, spoken) in zip(odd, own.encode_batch(odd), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert spoken == library.decode(want, skip_special_tokens=False)
    for i, row in rows_of(spark, "op4_trie_bpe").items():
        want = library.encode(texts[i] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(want)
        assert row.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        spoken = library.decode(want, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(spoken.encode()).hexdigest()


def base_personal(t):
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and crf_pii.luhn(digits):
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.findall("[0-9]", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def test_personal_data(spark, texts):
    for i, row in rows_of(spark, "op3_crf_pii").items():
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in base_personal(texts[i] or ""))
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(row.spans.split(","))


def test_field_on_held_out_sentences_and_exact_decoding():
    field = crf_pii.train(crf_pii.labelled_table(sequences=500))
    test = crf_pii.labelled_table(seed=99, sequences=150)
    sizes = test.groupby("sequence").size().to_numpy()
    begins = np.cumsum(sizes) - sizes
    scores = field.scores(field.numbers(list(test["word"])), begins)
    labels = field.decode(scores, begins)
    gold = test["label"].map({x: i for i, x in enumerate(crf_pii.LABELS)}).to_numpy()
    assert (labels == gold).mean() > 0.98
    noisy = scores + np.random.default_rng(1).normal(0, 3, scores.shape)
    found = field.decode(noisy, begins)
    for a, n in zip(begins, sizes, strict=True):  # plain Viterbi over whole sequences
        best, back = noisy[a], []
        for t in range(a + 1, a + n):
            step = best[:, None] + field.moves
            back.append(step.argmax(axis=0))
            best = step.max(axis=0) + noisy[t]
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        assert found[a : a + n].tolist() == path[::-1]


def test_secrets(spark, texts):
    key = r"((?i:password|passwd|secret|token|api_?key))"
    assign = re.compile(key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for i, row in rows_of(spark, "op8_secret_owners").items():
        t = texts[i] or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        spelled = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert row.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        numbers = Counter(k for _, k, _ in spans)
        assert (row.n_assign, row.n_access, row.n_hex) == (numbers[0], numbers[1], numbers[2])


def test_secrets_of_texts_with_very_many_matches(spark, documents):
    """Also candidates before, behind and within base spans."""
    from tarmac.llm.secret_owners import owned_secrets

    many = " ".join(f"{i:016x}" for i in range(30_000))
    token = "Qz" + "GhJk9" * 5
    mixed = f"password = {token}.x1 {token}aa {token}-{'0' * 16} {token}Z AKIA{'A1' * 9} " + many[:5000]
    rows = [(1, many, "en", "s1"), (2, mixed, "en", "s2"), (3, None, "en", None)]
    out = {r.doc_id: r for r in owned_secrets(documents(rows)).collect()}
    assert (out[1].n_assign, out[1].n_hex) == (0, 30_000)
    want = ",".join(f"hex:{17 * i}:{17 * i + 16}" for i in range(30_000))
    assert out[1].base_sha256 == hashlib.sha256(want.encode()).hexdigest() and out[1].spans == want
    # The token in the assignment and the one that holds a run of zeros meet base spans, two stand alone.
    alone = [mixed.index(token + "aa"), mixed.index(token + "Z")]
    added = [s for s in out[2].spans.split(",") if s.startswith("owned")]
    assert added == [f"owned:{alone[0]}:{alone[0] + len(token) + 2}", f"owned:{alone[1]}:{alone[1] + len(token) + 1}"]
    assert out[3].spans == "" and out[3].n_hex == 0


def test_owners_tell_copied_from_live(spark, documents):
    key = "Zx9" + "abcDEF12" * 3
    docs = documents([(1, f"a {key}1 b", "en", "s1"), (2, f"{key}2", "en", "s1"), (3, f"{key}2 x", "en", "s2")])
    from tarmac.llm.secret_owners import owned_secrets

    out = {r.doc_id: r for r in owned_secrets(docs).collect()}
    assert out[1].spans == f"owned:2:{2 + len(key) + 1}" and out[1].n_live == 1
    assert out[2].spans == "" and out[2].n_copied == 1 and out[3].max_repositories == 2


def test_languages_held_out(spark):
    lang = dict(zip(*pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "lang"]).to_pydict().values(), strict=True))
    rows = contract.queries()["op9_language_mixture"](spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_kneser_ney(spark, texts):
    from tarmac.llm.kneser_ney import discounts

    tokens = {i: [*words(t), None] for i, t in texts.items()}
    train = [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["start", *t[:-1]], t, strict=True))
    total, types = sum(c.values()), len(c)
    context, kinds, before = Counter(), defaultdict(lambda: [0, 0, 0, 0]), Counter()
    for (u, w), n in pairs.items():
        context[u] += n
        kinds[u][min(n, 3)] += 1
        before[w] += 1
    two = discounts([sum(n == k for n in pairs.values()) for k in (1, 2, 3, 4)])
    one = discounts([sum(n == k for n in before.values()) for k in (1, 2, 3, 4)])
    rest = sum(one[min(n, 3)] for n in before.values()) / len(pairs)
    for i, row in rows_of(spark, "op10_kneser_ney").items():
        score = base = 0.0
        for u, w in zip(["start", *tokens[i][:-1]], tokens[i], strict=True):
            p = (before[w] - one[min(before[w], 3)]) / len(pairs) + rest / (types + 1)
            if context[u]:
                n = pairs[u, w]
                p = (n - two[min(n, 3)] + sum(d * k for d, k in zip(two, kinds[u], strict=True)) * p) / context[u]
            score += math.log10(p)
            base += math.log10((c[w] + 1) / (total + types + 1))
        assert row.train_tokens == total and row.n_tokens == len(tokens[i])
        assert row.n_known == sum(c[w] > 0 for w in tokens[i])
        assert row.score == pytest.approx(score) and row.base_score == pytest.approx(base)


def brute_overlaps(texts, items):
    """Documents and items with a stretch of 12 words in a row, or with a stretch that scores as well."""
    found = set()
    for i, t in texts.items():
        w = words(t)
        for item, text in items.items():
            b = words(text)
            for shift in range(-len(b), len(w)):
                low, high = max(0, -shift), min(len(b), len(w) - shift)
                equal = np.array([b[k] == w[k + shift] for k in range(low, high)], bool)
                if equal.sum() >= min(12, -(-4 * len(b) // 5)) and len(b) >= 6:
                    if spaced_seeds.best_stretch(equal)[2] >= min(12, -(-4 * len(b) // 5)):
                        found.add((i, item))
    return found


def test_benchmark_overlaps_with_substitutions(spark, documents):
    r = random.Random(2)
    items = {k: " ".join(f"b{r.randrange(500)}" for _ in range(r.choice([8, 20, 40]))) for k in range(6)}
    texts = {}
    for i in range(40):
        w = [f"d{r.randrange(900)}" for _ in range(60)]
        if i % 2:
            part = items[i % 6].split()
            for _ in range(r.choice([0, 1, 3])):
                part[r.randrange(len(part))] = "other"
            w[10:10] = part
        texts[i] = " ".join(w)
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = spaced_seeds.benchmark_overlaps(documents(list(texts.items())), table).collect()
    got = {(x.doc_id, x.item_id) for x in found}
    want = brute_overlaps(texts, items)
    assert got <= want and len(want - got) <= len(want) // 10  # seeds can miss heavily edited passages


def test_passages_pasted_into_documents(spark, documents):
    r = random.Random(4)

    def prose(n):
        return " ".join(f"w{r.randrange(10**6)}" + ("." if k % 9 == 8 else "") for k in range(n))

    shared = prose(63)
    near = shared.split()
    near[30] = "changed"
    texts = [prose(80) for _ in range(20)]
    texts[3] += " " + shared + " " + prose(20)
    texts[8] = prose(12) + " " + shared
    texts[11] += "\n" + " ".join(near) + "\n" + prose(10)
    texts[15] += "\n" + shared
    from tarmac.llm.passages import repeated_passages

    found = repeated_passages(documents(texts)).collect()
    assert {x.doc_id for x in found} == {3, 8, 11, 15}
    assert all(x.first_doc_id == 3 and x.removed == (x.doc_id != 3) and x.n_words >= 25 for x in found)


def test_bands_reach_the_recall():
    bands, rows = tuned_bands(0.8, 0.998)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.998 and (bands, rows) == (4, 1)


def test_tool_links_of_conversations(spark):
    table = pq.read_table(f"{FOLDER}/conversations.parquet").to_pylist()
    calls = {(t["conv_id"], t["turn"]): t for t in table if t["role"] == "user"}
    answers = {(t["conv_id"], t["turn"] - 1): t for t in table if t["role"] == "assistant"}
    out = contract.queries()["op5_tool_links"](spark, FOLDER).collect()
    orphans = {k: t for k, t in answers.items() if k not in calls}
    assert {(r.conv_id, r.turn) for r in out if r.copies} == set(calls)
    assert {(r.conv_id, r.turn - 1) for r in out if not r.copies} == set(orphans)
    for r in out:
        value = json.loads(r.json)
        assert r.json == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        answer = answers.get((r.conv_id, r.turn if r.copies else r.turn - 1))
        assert value.get("result") == ((answer["text"] or "") if answer else None)
        if not r.copies:
            assert r.errors == "result without a call" and not r.valid
            continue
        text = calls[r.conv_id, r.turn]["text"] or ""
        if len(text) % 13 == 0:
            assert r.errors == "not an object" and value["arguments"] == {}
        else:
            assert value["arguments"].get("query") == (None if len(text) % 11 == 0 else text)
        depth, turn = 0, r.turn
        while (r.conv_id, turn - 2) in calls:
            depth, turn = depth + 1, turn - 2
        assert r.depth == depth


def test_pipeline(spark, texts):
    table = {r["doc_id"]: r for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}
    items = dict(zip(*pq.read_table(f"{FOLDER}/benchmark.parquet").to_pydict().values(), strict=True))
    kept = {i: t for i, t in texts.items() if t and re.search(r"[^\W\d_]", t)}
    groups = brute_components(kept)
    kept = {i: t for i, t in kept.items() if groups[i][1] == i}
    plain = {k: " ".join(words(t)) for k, t in items.items()}
    held = {i for i, t in kept.items() if any(f" {b} " in f" {' '.join(words(t))} " for b in plain.values())}
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert not held & set(found)
    close = {i for i, t in kept.items() if any(len(set(words(t)) & set(b.split())) >= 12 for b in plain.values())}
    assert set(kept) - held - close <= set(found) <= set(kept)
    own = trie_bpe.load(tokenizer_path())
    field = crf_pii.train(crf_pii.labelled_table())
    for i, row in found.items():
        ((base, more),) = crf_pii.find_spans([texts[i]], field)
        ((ids, _),) = own.encode_batch([crf_pii.covered(texts[i], base + more)])
        assert row.ids == np.frombuffer(ids, "<u4").tolist() and row.source == table[i]["source"]


@pytest.mark.parametrize(("template", "own"), [(30, 10), (40, 10)])
def test_similar_lines_that_share_a_template(spark, documents, template, own):
    from pyspark.sql import functions as F

    from tarmac.llm import passages

    r = random.Random(template)
    shared = [f"t{k}" for k in range(template)]
    lines = []
    for family in range(60):
        line = shared + [f"f{family}x{k}" for k in range(own)]
        lines += [" ".join(line), " ".join([*line, f"end{r.randrange(10**6)}"])]
    docs = documents(lines).select("doc_id", "text", F.col("doc_id").alias("row"))
    units = docs.mapInArrow(passages._units, passages.UNITS).cache()
    key = {x.row: x.key for x in units.where("first_word = 0 and size(bands) > 0").collect()}
    root = {x.key: x.root for x in passages._near_lines(docs, units).collect()}
    want = brute_components(dict(enumerate(lines)))
    assert len({w[1] for w in want.values()}) == 60
    got = {i: root.get(k, k) for i, k in key.items()}
    assert all((got[i] == got[j]) == (want[i][1] == want[j][1]) for i in got for j in got)


def test_first_occurrences_stay_next_to_copies(spark, documents):
    from tarmac.llm.passages import repeated_passages

    r = random.Random(8)
    p, q, z = (" ".join(f"{c}{r.randrange(10**6)}" for _ in range(30)) + "." for c in "pqz")
    found = repeated_passages(documents([(1, q), (2, p + "\n" + q), (3, p), (4, q + "\n" + p), (None, z), (None, z)])).collect()
    got = sorted((x.doc_id or 0, x.first_word, x.n_words, x.first_doc_id, x.removed) for x in found)
    assert got == [
        (0, 0, 30, None, False), (0, 0, 30, None, True),
        (1, 0, 30, 1, False),
        (2, 0, 30, 2, False), (2, 30, 30, 1, True),
        (3, 0, 30, 2, True),
        (4, 0, 30, 1, True), (4, 30, 30, 2, True),
    ]


def test_shared_stretches_are_found_up_to_their_ends(spark, documents):
    from tarmac.llm.passages import repeated_passages

    r = random.Random(12)

    def prose(n):
        return " ".join(f"w{r.randrange(10**6)}" for _ in range(n))

    want, texts = set(), []
    for k, n in enumerate((25, 26, 30, 37, 50, 80, 200)):
        shared, before, after = prose(n), r.randrange(1, 60), r.randrange(1, 60)
        texts += [f"{prose(before)} {shared} {prose(9)}", f"{prose(after)} {shared} {prose(40)}"]
        want |= {(2 * k, before, n, 2 * k, False), (2 * k + 1, after, n, 2 * k, True)}
    found = repeated_passages(documents(texts)).collect()
    assert {tuple(x) for x in found} == want


def test_words_next_to_base_spans_are_kept():
    field = crf_pii.train(crf_pii.labelled_table())
    text = "write to john(at)mail.com jane@mail.com bob[at]post.org or call (123) 456-7890 +1 555 123 4567 please"
    ((base, more),) = crf_pii.find_spans([text], field)
    found = {text[a:b] for _, a, b in base + more}
    assert {"john(at)mail.com", "jane@mail.com", "bob[at]post.org", "(123) 456-7890", "+1 555 123 4567"} == found
    assert crf_pii._added("john(at)a.org,jane@a.org", np.array([1]), [("email", 14, 24)]) == [("email", 0, 13)]
    assert crf_pii._added("mailto:jane@a.org 10.0.0.1:80", np.array([1, 2]), [("email", 7, 17), ("ip", 18, 26)]) == []
    assert crf_pii.base_spans("1" * 5000 + ".1.1.1") == []
    assert crf_pii.base_spans("0" * 5000 + "1.0.255.000001") == [("ip", 0, 5014)]


def test_items_that_agree_in_four_words_of_five(spark, documents):
    items = {k: " ".join(f"i{k}x{j}" for j in range(n)) for k, n in enumerate((15, 17, 20, 25, 1, 3, 5))}
    texts, want = [], set()
    for k, places in ((0, (6, 9)), (0, (7,)), (1, (3, 12)), (2, (2, 3, 11)), (3, (8, 9, 16)), (4, ()), (5, ()), (6, ()), (5, (1,)), (6, (4,))):
        w = items[k].split()
        for p in places:
            w[p] = "other"
        if sum(x != "other" for x in w) >= (len(w) if len(w) < 6 else 0.8 * len(w)):
            want.add((len(texts), k))
        texts.append(" ".join(["before"] * 9 + w + ["after"] * 9))
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = spaced_seeds.benchmark_overlaps(documents(texts), table, whole=True).collect()
    assert {(x.doc_id, x.item_id) for x in found} == want and len(want) == 8
