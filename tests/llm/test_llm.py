"""The training-data operators against plain versions, with null, empty, long, repeated and clashing rows."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("reelmill.llm")

from reelmill.llm import bpe, language_id, lz_fingerprint, minhash, mixing, near_vectors, pretokens, quality, suffix_dedup, token_records, toxicity  # noqa: E402

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tkey string, rep long, g long, size long"
WORDS = "the of and to in is that for it was on are as with his they at be this from".split()


def texts():
    rng = random.Random(4)
    passage = " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(90))
    make = lambda n: " ".join(rng.choice(WORDS) + str(rng.randint(0, 999)) for _ in range(n))
    base = make(200)
    near = " ".join(w if i % 60 else "changed" for i, w in enumerate(base.split()))
    return [None, "", "  \n", "one", "one", base, base, near, make(150), make(30) + " " + passage + " é" * 3, make(20) + passage, "a" * 1500, "ß" * 5000, make(5) + "　漢字 ½  x", make(300)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None][i % 3], None, "x", 1, 1, 1) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def phrases(text):
    b, seen, s = text.encode(), set(), 0
    for e in range(1, len(b) + 1):
        if b[s:e] not in seen:
            seen.add(b[s:e])
            s = e
    return seen


def test_lz_edited(docs, spark):
    """An edited text's fingerprint is that of a document with this text; the likeness is near that of the phrase sets."""
    every = [r["text"] or "" for r in docs.orderBy("doc_id").collect()]
    edited = [t[: len(t) - len(t) // 4] + every[(i + 1) % len(every)][: len(t) // 4] for i, t in enumerate(every)]
    got = {r["doc_id"]: r for r in lz_fingerprint.fingerprint_documents(docs).collect()}
    own = {r["doc_id"]: r for r in lz_fingerprint.fingerprint_documents(spark.createDataFrame(list(enumerate(edited)), "doc_id long, text string")).collect()}
    for i, (t, e) in enumerate(zip(every, edited, strict=True)):
        assert got[i]["edited_fingerprint"] == own[i]["fingerprint"] and got[i]["n_chars"] == len(t)
        a, b = phrases(t), phrases(e)
        assert abs(got[i]["near_edited"] - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.12


def test_lz_repeated_and_null_ids(spark):
    rows = [(None, "a b"), (None, "a b"), (1, "x"), (1, "y"), (2, None)]
    got = lz_fingerprint.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"]) for r in got) == [-1, -1, 1, 1, 2]


def test_lz(docs, none):
    rows = docs.collect()
    got = {r["doc_id"]: r for r in lz_fingerprint.fingerprint_documents(docs).collect()}
    all_texts = [r["text"] or "" for r in rows]
    sets = []
    for t in all_texts:
        b, seen, s = t.encode(), set(), 0
        for e in range(1, len(b) + 1):
            if b[s:e] not in seen:
                seen.add(b[s:e])
                s = e
        sets.append(seen)
    for i, t in enumerate(all_texts):
        follow, q = all_texts[(i + 1) % len(all_texts)], len(t) // 4
        assert got[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - q] + follow[:q]).encode()).hexdigest()
        both = sets[i] | sets[(i + 1) % len(sets)]
        want = len(sets[i] & sets[(i + 1) % len(sets)]) / len(both) if both else 1.0
        assert abs(got[i]["near_next"] - want) < 0.12
    assert got[3]["fingerprint"] == got[4]["fingerprint"]
    assert lz_fingerprint.fingerprint_documents(none).count() == 0


def test_near_documents(docs, none, spark):
    def shingles(t, n):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    for n in (2, 5):
        rows = docs.collect()
        sets = [shingles(r["text"], n) for r in rows]
        up = list(range(len(rows)))
        for _ in rows:
            for a in range(len(rows)):
                for b in range(len(rows)):
                    if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        up[a] = up[b] = min(up[a], up[b])
        for block in (2, 512):
            got = {r["doc_id"]: r for r in minhash.near_documents(docs, words=n, block=block).collect()}
            assert [got[i]["component_id"] for i in range(len(rows))] == up
            assert [got[i]["n_shingles"] for i in range(len(rows))] == [len(s) for s in sets]
    assert minhash.near_documents(none).count() == 0
    odd = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "x y z"), (2, "x y z")], "doc_id long, text string")
    assert sorted((r["doc_id"] or -1, r["kept"]) for r in minhash.near_documents(odd, words=2).collect())[0] == (-1, True)


def without_repeats(rows, length):
    """(id, bytes) -> id: (bytes, removed, runs removed, digest of the rest), window by window."""
    seen = Counter(b[i : i + length] for _, b in rows for i in range(len(b) - length + 1))
    want = {}
    for i, b in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        want[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return want


def test_suffix_dedup(docs, none):
    want = without_repeats([(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()], 400)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.removed_bytes(docs).collect()}
    assert got == want
    assert any(w[1] for w in want.values()) and suffix_dedup.without_repeats(none).count() == 0
    assert set(docs.columns) <= set(suffix_dedup.without_repeats(docs).columns)


@pytest.mark.parametrize(("piece", "filler"), [(700, 3_000), (suffix_dedup.PIECE, suffix_dedup.PIECE + 400_000)])
def test_suffix_dedup_across_pieces(spark, piece, filler):
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    passage, start, between = noise(600), noise(100), noise(filler)
    # one text alone has the passage, in two of its pieces; another has none that repeats
    rows = [(1, start + passage + between + passage + "."), (2, noise(3_000))]
    got = {r["doc_id"]: tuple(r)[1:4] for r in suffix_dedup.removed_bytes(spark.createDataFrame(rows, "doc_id long, text string"), piece=piece).collect()}
    assert got == {1: (len(rows[0][1]), 1_200, 2), 2: (3_000, 0, 0)}


def test_two_stage():
    rng = random.Random(1)
    for _ in range(50):
        t = bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 80)))
        assert suffix_dedup.two_stage(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:])
    for _ in range(200):
        length, t = rng.choice((3, 5, 8, 11)), bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 80)))
        order = suffix_dedup.two_stage(t, length).tolist()
        assert sorted(order) == list(range(len(t))) and sorted(windows := [t[i : i + length] for i in order]) == windows


def test_common_prefixes():
    rng = random.Random(3)
    t = bytes(rng.choice(b"aab") for _ in range(300))
    a, b = (np.array([rng.randrange(280) for _ in range(400)]) for _ in range(2))
    plain = lambda i, j: next(k for k in range(21) if k == 20 or t[i + k] != t[j + k])
    assert suffix_dedup.common_prefixes(t, a, b, 20).tolist() == [plain(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    order = suffix_dedup.two_stage(b"a" * 5_000 + b"b", 40)
    assert sorted(order.tolist()) == list(range(5_001))


@pytest.mark.parametrize("crowd", [1, 3, 400])
def test_suffix_dedup_of_crowds(spark, crowd):
    """One passage in many contexts, some of which agree for a while; one text in copies, one periodic."""
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choices("abcdefgh", k=n))
    passage, lead = noise(130), [noise(30) for _ in range(3)]
    rows = [(i, noise(20) + rng.choice(lead)[rng.randrange(30) :] + passage + rng.choice(lead)[: rng.randrange(30)] + noise(20)) for i in range(40)]
    rows += [(40, rows[0][1]), (41, "ab" * 300), (42, "ab" * 70 + "c"), (43, passage), (44, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.removed_bytes(docs, length=80, piece=200, crowd=crowd).collect()}
    assert got == without_repeats([(i, (t or "").encode()) for i, t in rows], 80)


def test_suffix_dedup_keeps_any_columns(spark):
    names = "_tkey", "_rkey", "_spans", "_whole", "tkey", "row", "doc", "s", "whole", "spans", "_kept"
    rows = [("p" * 500, *names), ("q" * 10, *names), (None, *names)]
    out = suffix_dedup.without_repeats(spark.createDataFrame(rows, ["text", *names]))
    assert out.columns == ["text", *names[:-1], "_n_bytes", "_n_removed", "_n_spans", "_kept"]
    assert sorted((r["_n_bytes"], r["_n_removed"], r["_tkey"]) for r in out.collect()) == [(0, 0, "_tkey"), (10, 0, "_tkey"), (500, 500, "_tkey")]


def test_bpe(docs, none):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in bpe.encoded(docs, path, P.PATTERN).collect()}
    for r in docs.collect():
        assert got[r["doc_id"]]["ids"] == lib.encode_ordinary(r["text"] or "")
        assert bytes(got[r["doc_id"]]["decoded"]) == (r["text"] or "").encode()
    rng, e = random.Random(2), bpe.encoder(path, P.PATTERN)
    for _ in range(500):
        t = "".join(rng.choice("ab  \n\t'sré漢ß\x1c\x85.!²12　<|endoftext|>") for _ in range(40))
        assert e.encode([t])[0].tolist() == lib.encode_ordinary(t) and "".join(pretokens.pieces(t)) == t
    hard = ["", "a" * 50_000, "\0\0\0", "".join(rng.choice("ab") for _ in range(20_000)), "".join(rng.choice("aeéß漢\0 \n") for _ in range(20_000))]
    hard += ["".join(rng.choice("abcdeést ") for _ in range(rng.randrange(40))) for _ in range(2_000)]
    assert [i.tolist() for i in e.encode(hard)] == [lib.encode_ordinary(t) for t in hard]
    assert bpe.digests(none, path, P.PATTERN).count() == 0


def test_cutter():
    import regex

    find, cut = regex.compile(pretokens.BYTE_LEVEL).findall, pretokens.cutter(pretokens.BYTE_LEVEL)
    assert all(regex.match(r"\p{L}", chr(c)) for c in range(0x110000) if chr(c).isalpha())
    rng = random.Random(4)
    for _ in range(20_000):
        piece = "".join(rng.choice(" ab'sé漢²1.,!?\n") for _ in range(rng.randint(1, 6)))
        assert list(cut(piece)) == find(piece), piece


def test_records(docs, none, spark, tmp_path):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    lib.encode_special_tokens = True
    got, at = {r["doc_id"]: r for r in token_records.token_digests(docs, path).collect()}, 0
    for r in docs.orderBy("doc_id").collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        g = got[r["doc_id"]]
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    assert token_records.token_digests(none, path).count() == 0
    import io

    record = bytearray(token_records.framed(b"abc"))
    assert token_records.unframed(io.BytesIO(record), 0) == b"abc"
    record[13] ^= 1
    with pytest.raises(ValueError):
        token_records.unframed(io.BytesIO(record), 0)


def test_records_added_tokens(spark):
    from tokenizers import Tokenizer

    path, rng = P.path("byte_bpe_50k.json"), random.Random(5)
    lib, e = Tokenizer.from_file(path), token_records.TextEncoder(path)
    texts = ["end<|endoftext|>start", "<|endoftext|>", "<|endoftext|><|endoftext|> a", " a  <|endoftext|>  b ", "<|endoftext", "one"]
    texts += ["".join(rng.choices(["a", "b ", " ", "  ", "\n", "'s", "é漢", "<|", "|>", "endoftext", "<|endoftext|>"], k=12)) for _ in range(2_000)]
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(i, dtype=e.kind).tolist() for i in e.encode(texts)] == want and want[0] == [437, 50256, 9688]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, at = {r["doc_id"]: r for r in token_records.token_digests(docs, path).collect()}, 0
    for i, ids in enumerate(x + [2] for x in want):
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)


@pytest.mark.parametrize("token", [{"lstrip": True}, {"single_word": True}, {"content": "<|end"}])
def test_added_tokens_of_other_files(tmp_path, token):
    import json

    from tokenizers import Tokenizer

    spec = json.load(open(P.path("byte_bpe_50k.json")))
    spec["added_tokens"].append(spec["added_tokens"][0] | {"id": 50257, "content": "<|pad|>"} | token)
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(spec))
    lib, e = Tokenizer.from_file(str(path)), token_records.TextEncoder(str(path))
    texts = ["a <|pad|> b", "a<|pad|>b", "<|endoftext|> <|end <|pad|><|endoftext|>"]
    assert [np.frombuffer(i, dtype=e.kind).tolist() for i in e.encode(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_mix(docs, none):
    rows = docs.collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len((r["text"] or "").replace("　", "x").split(None) if r["text"] else [])
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and all(g["taken"] <= 3 * g["size"] for g in got)
    assert mixing.mix(docs).collect() is not None and sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs).collect()))
    total = sum(g["size"] for g in got)
    assert math.isclose(sum({g["source_size"]: g["target"] for g in got}.values()), total, rel_tol=1e-9)
    assert mixing.mixed_documents(docs).count() == sum(g["repeats"] for g in got)
    assert mixing.mixed_documents(docs).columns == docs.columns and mixing.mix(none).count() == 0


def test_water_filling(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), ("d", 5), ("e", 0)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.water_filled(rows).collect()}
    weight = dict(zip("abcde", (5, 2, 1, 5, 2), strict=True))
    cap, left, free = {"a": 30, "b": 3000, "c": 3000, "d": 15, "e": 0}, 2015.0, set("abcde")
    while over := {s for s in free if weight[s] * left / sum(weight[x] for x in free) > cap[s]}:
        free -= over
        left -= sum(cap[s] for s in over)
    assert all(math.isclose(got[s], weight[s] * left / sum(weight[x] for x in free) if s in free else cap[s]) for s in got)


@pytest.mark.parametrize(("block", "scanned"), [(8, 2), (8, 64), (2048, 64)])
def test_near_vectors(spark, block, scanned):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(60, 16)).astype("f4")
    v[20:30] = v[19] + 0.05 * rng.normal(size=(10, 16))
    v[31] = v[30]
    rows = [(i, x.tolist(), i % 2 if i < 19 else 0) for i, x in enumerate(v)]
    rows += [(60, None, 0), (61, [0.0] * 16, 0), (62, [float("nan")] * 16, 0), (63, v[19].tolist(), None), (64, [1.0, None], 0), (65, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    hit = (u @ u.T >= 0.98) & np.equal.outer([r[2] for r in rows[:60]], [r[2] for r in rows[:60]]) & ~np.eye(60, dtype=bool)
    up = list(range(66))
    for _ in range(60):
        for a, b in zip(*np.nonzero(hit), strict=True):
            up[a] = up[b] = min(up[a], up[b])
    got = {r["vec_id"]: r for r in near_vectors.near_vectors(df, block=block, scanned=scanned).collect()}
    assert [got[i]["component_id"] for i in range(66)] == up
    assert [got[i]["n_links"] for i in range(60)] == hit.sum(1).tolist() and got[63]["n_links"] == 0
    assert near_vectors.near_vectors(df.limit(0)).count() == 0
    again = df.union(spark.createDataFrame([(70, v[30].tolist(), 0), (70, (-v[3]).tolist(), 0), (None, v[30].tolist(), 0)], df.schema))
    found = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["n_links"], r["component_id"]) for r in near_vectors.near_vectors(again, block=block).collect())
    assert found[0] == (-1, 0, None) and found[-2:] == [(70, 0, 70), (70, 2, 30)] and (31, 2, 30) in found


def test_estimates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[150:] = x[:150] + 0.01 * rng.normal(size=(150, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = near_vectors.rotation(64)
    codes, factors = near_vectors.encode(x, turn)
    guess, true = near_vectors.estimates(x @ turn, codes, factors), x @ x.T
    assert abs((guess - true).mean()) < 0.01
    for t in (-0.5, 0.3, 0.9, 0.98):
        hit = guess >= near_vectors.least_estimate(factors, t)[None, :]
        assert hit[true >= t].all() and (t < 0.9 or hit.mean() < 0.2)


def test_classifiers(spark, none):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        lang, bad, toxic = ("en", "xx")[i % 2], i % 5 == 0, i % 7 == 0
        words = [rng.choice(WORDS if lang == "en" else [w[::-1] + "qu" for w in WORDS]) for _ in range(40)]
        words += ["idiotic"] * toxic + ["###!!"] * (3 * bad)
        rng.shuffle(words)
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(None, "the of and", "en"), (1000, None, None), (1001, "123 !!", "en"), (1002, "½ ²", None), (1003, "① ② Ⅳ", None), (1004, "\u0301 ٣ _", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame([*labels, (None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    model = language_id.train(docs)
    got = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    for i in range(0, 400, 37):  # word by word
        words = [model.logs[model.word_rows(w)].mean(0) for w in rows[i][1].lower().replace("#", " ").replace("!", " ").split()]
        odds = np.exp(np.mean(words, axis=0) * min(len(words), language_id.EVIDENCE))
        assert got[i]["lang_pred"] == model.languages[int(odds.argmax())] and abs(got[i]["score"] - odds.max() / odds.sum()) < 1e-6
    assert all(got[i]["held_out"] == held(i) for i in range(400)) and not got[None]["held_out"]
    assert np.mean([got[i]["lang_pred"] == rows[i][2] for i in range(400) if held(i)]) > 0.98
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in range(1000, 1005))
    net = quality.train(docs, lab)
    q = {r["doc_id"]: r for r in quality.score(docs, net).collect()}
    for i in range(0, 400, 37):
        of = np.concatenate([quality.word_features([w], len(net.weight))[0] for w in rows[i][1].split()])
        assert abs(q[i]["score"] - 1 / (1 + np.exp(-net.bias - net.weight[of].mean()))) < 1e-9
    good = [q[i]["score"] for i in range(400) if held(i) and labels[i][1]]
    poor = [q[i]["score"] for i in range(400) if held(i) and not labels[i][1]]
    assert min(len(good), len(poor)) > 3 and np.mean([g > p for g in good for p in poor]) > 0.95
    chain = toxicity.train(docs, lab, ["quality", "toxic"])
    t = {r["doc_id"]: r for r in toxicity.classify(docs, chain).collect()}
    for i in range(0, 400, 37):
        has, before = {f for piece in rows[i][1].split() for f in toxicity.features(piece)}, []
        for w in chain.links:
            z = sum(w[at] for f, at in chain.place.items() if f in has) + sum(p * x for p, x in zip(before, w[len(chain.place) :], strict=False)) + w[-1]
            before.append(1 / (1 + math.exp(-z)))
        assert np.allclose([t[i]["p_quality"], t[i]["p_toxic"]], before) and t[i]["score"] == t[i]["p_toxic"]
    assert np.mean([t[i]["predicted"] == labels[i][2] for i in range(400) if held(i)]) > 0.95
    empty = none.select("doc_id", "text", "lang")
    assert language_id.identify(empty, language_id.train(empty)).count() == 0
    assert quality.score(empty, quality.train(empty, lab)).count() == 0
    assert toxicity.classify(empty, toxicity.train(empty, lab, ["toxic"])).count() == 0


def test_pipeline(spark, tmp_path, docs):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    found = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, found, str(tmp_path))
        assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    out = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    ids = {r["doc_id"] for r in out}
    assert out and 6 not in ids and not ids & {0, 1, 2}
    assert all(r["n_tokens"] == len(r["ids"]) for r in out)


def test_repeated_and_null_ids(spark):
    """Rows count one by one: null ids first, repeated ones by text."""
    path, bpe_path = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.createDataFrame([(None, "b", None), (1, "one two", "s"), (1, "one two", "s"), (1, None, None)], "doc_id long, text string, source string")
    got = sorted((r["start"], -1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"]) for r in token_records.token_digests(docs, path).collect())
    assert got == [(0, -1, 2), (2, 1, 1), (3, 1, 3), (6, 1, 3)]
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in bpe.digests(docs, bpe_path, P.PATTERN).collect()) == [(0, 1), (1, 0), (1, 2), (1, 2)]
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == 4 and sum(r["size"] for r in mixed) == 5


def test_pipeline_language_with_clashing_columns(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    names = ["doc_id", "text", "lang", "score", "lang_pred", "held_out", "_text", "_id"]
    rows = [(i, f"the of and {w} words", "en", "a", "b", "c", "d", "e") for i, w in enumerate(WORDS * 3)] + [(99, "12 !!", "en", *"abcde")]
    out = corpus_pipeline.language(spark, spark.createDataFrame(rows, names), "")
    assert out.columns == names and {tuple(r)[3:] for r in out.collect()} == {tuple("abcde")} and out.where("doc_id = 99").count() == 0


def test_pipeline_near_duplicates_of_repeated_ids(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(7)
    a, b, c, d = (" ".join(rng.choice(WORDS) + str(rng.randint(0, 999)) for _ in range(120)) for _ in range(4))
    near = d + " more"
    # 5 has a copy of 2's text and one of its own; 6 is there twice; 7 has two texts that are near; null ids stay
    rows = [(2, a), (5, a), (5, b), (6, c), (6, c), (7, d), (7, near), (None, a), (8, ""), (8, ""), (9, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(map(tuple, corpus_pipeline.near_duplicates(spark, docs, "").collect()))
    assert got - Counter([(7, d), (7, near)]) == Counter([(2, a), (5, b), (6, c), (None, a), (8, ""), (8, "")])
    assert got[7, d] + got[7, near] == 1


def test_pipeline_stages_against_plain_versions(spark, docs, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    tiktoken, duckdb = pytest.importorskip("tiktoken"), pytest.importorskip("duckdb")
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    found = docs.select(*names)
    by_id = lambda rows: sorted(rows, key=lambda r: r[0])
    want = by_id(map(tuple, found.collect()))
    stages = dict(corpus_pipeline.STAGES)

    def after(name):
        nonlocal found
        found = stages[name](spark, found, str(tmp_path))
        found.write.parquet(f"{tmp_path}/{name}")
        found = spark.read.parquet(f"{tmp_path}/{name}")
        return by_id(map(tuple, found.collect()))

    # the decision by the model, one word at a time
    model = language_id.train(found)

    def sure(text):
        words = [model.logs[r].mean(0) if (r := model.word_rows(w)) else np.zeros(len(model.languages)) for w in language_id.words_of((text or "").lower())]
        if not words:
            return False
        odds = np.exp(np.mean(words, axis=0) * min(len(words), language_id.EVIDENCE))
        return odds.max() / odds.sum() >= corpus_pipeline.MIN_LANGUAGE_SCORE

    want = [r for r in want if sure(r[1])]
    assert after("language_id") == want

    def shingles(text):
        w = text.encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets, up = [shingles(r[1]) for r in want], list(range(len(want)))
    for _ in want:
        for a in range(len(want)):
            for b in range(len(want)):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    up[a] = up[b] = min(up[a], up[b])
    want = [r for i, r in enumerate(want) if up[i] == i]
    assert after("minhash_near_dedup") == want

    length = corpus_pipeline.PASSAGE_BYTES
    seen = Counter(b[i : i + length] for r in want for b in [r[1].encode()] for i in range(len(b) - length + 1))
    cut = []
    for i, text, lang, source, _ in want:
        b, rest, run = text.encode(), b"", b""
        gone = {k for s in range(len(b) - length + 1) if seen[b[s : s + length]] > 1 for k in range(s, s + length)}
        for k in range(len(b) + 1):
            if k in gone:
                run += b[k : k + 1]
            else:
                rest += (run if len(run.split()) <= 50 else b"") + b[k : k + 1]
                run = b""
        text = rest.decode("utf-8", "ignore")
        cut.append((i, text, lang, source, len(text)))
    assert cut != want and after("suffix_array_dedup") == cut

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", cut)
    repeats = {r[0]: r[-1] for r in con.execute(mixing.ORACLE_SQL).fetchall()}
    want = [r for r in cut for _ in range(repeats[r[0]])]
    found = stages["mixing"](spark, found, str(tmp_path))
    assert by_id(map(tuple, found.collect())) == want

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(corpus_pipeline.TOKENIZER), "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(r[0], ids, len(ids), hashlib.sha256(r[1].encode()).hexdigest()) for r in want for ids in [lib.encode_ordinary(r[1])]]
    assert by_id(map(tuple, stages["byte_bpe"](spark, found, str(tmp_path)).collect())) == rows
