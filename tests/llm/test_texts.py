import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from .conftest import SF
from tokenizers import Tokenizer

from tallyforge.llm import attribution, chat, packing, queries, secrets, words


@pytest.fixture(scope="module")
def vocabulary():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_word_ids_match_the_vocabulary(spark, vocabulary, odd_docs):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [r.text or "" for r in odd_docs.collect()]
    texts += ["It's İstanbul's ΣΑΣ Σ, don't\x1cstop x́y　z \x0b\x0c", "a<|startoftext|>b <|endoftext|>", "日本語 text"]
    ids, to = words.Encoder(words.default_path()).encode(texts)
    for k, t in enumerate(texts):
        assert ids[to[k] : to[k + 1]].tolist() == vocabulary.encode(t, add_special_tokens=False).ids


def check_packing(pieces, docs, vocabulary):
    ids = {d: np.array([*vocabulary.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in docs}
    seen = Counter()
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
        assert p.doc_tokens == len(ids[p.doc_id])
        seen[p.doc_id] += p.length
    assert seen == {d: len(v) * sum(d == x for x, _ in docs) for d, v in ids.items()}
    end, used = {}, Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == end.get(p.sequence_id, 0)
        end[p.sequence_id] = p.offset + p.length
        used[p.sequence_id] += 1
    assert max(end.values()) <= 2048 and max(used.values()) <= 64
    padded = sum(n if n & (n - 1) == 0 else 2048 for n in end.values())
    assert 1 - sum(end.values()) / padded < 0.01


def test_packing(spark, vocabulary, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_packing(queries.op4_vector_packing(spark, SF).collect(), docs, vocabulary)
    check_packing(packing.pack_documents(odd_docs).collect(), [(r.doc_id, r[1]) for r in odd_docs.collect()], vocabulary)
    assert packing.pack_documents(no_docs).count() == 0


def test_fill_keeps_all_limits():
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 900, 400)
    loss = (tokens * rng.random(400)).astype(int)
    limits = packing.Limits(1000, 5, 400)
    bins = packing.fill(tokens, np.minimum(loss, 400), limits, False)
    assert sorted(k for b in bins for k, _ in b) == list(range(400))
    for b in bins:
        assert sum(n for _, n in b) <= 1000 and len(b) <= 5 and sum(min(loss[k], 400) for k, _ in b) <= 400
    with pytest.raises(ValueError):
        packing.fill(np.array([1001]), np.array([0]), limits, False)


def test_pack_examples(spark):
    rows = spark.createDataFrame([(i, 100 + i, None if i == 3 else i) for i in range(50)], "id int, t long, l long")
    got = packing.pack_examples(rows, "t", "l", packing.Limits(512, 4, 60)).collect()
    assert len(got) == 50
    for s in {r.sequence_id for r in got}:
        own = [r for r in got if r.sequence_id == s]
        assert sum(r.t for r in own) <= 512 and len(own) <= 4 and sum(r.l or 0 for r in own) <= 60


def test_pack_examples_keeps_odd_columns(spark):
    """Clashing names, nulls, large whole numbers and repeated rows come back as they were."""
    rows = [(2**62 + 1, 5, 3, None), (None, None, None, "x"), (2**62 + 1, 5, 3, None), (7, 512, 60, "y")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "sequence_id long, t int, l int, offset string, Segment int")
    got = packing.pack_examples(df, "t", "l", packing.Limits(512, 4, 60))
    assert got.columns == [*df.columns, "sequence_id", "offset", "segment"]
    assert {tuple(r)[:5] for r in got.collect()} == set(map(tuple, df.collect()))
    assert packing.pack_examples(df.where("false"), "t", "l").count() == 0


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution_matches_brute_force(spark, rule):
    """Each section's tokens, from whole texts encoded by themselves, one token at a time."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 5 = 0")
    got = attribution.attribute(docs, "doc_id", ["source", "lang", "text"], ("text",), rule).toPandas()
    coder = attribution.Lengths(attribution.default_path()).encoding
    for r in docs.collect():
        parts = [f"{r.source}\n", f"{r.lang}\n", *re.findall(r"[^\n]*\n|[^\n]+", r.text or "")]
        parts += [""] if not r.text else []
        owner = [k for k, p in enumerate(parts) for _ in p.encode()]
        count, crossing, at = [0.0] * len(parts), [0] * len(parts), 0
        for i in coder.encode_ordinary("".join(parts)):
            n = len(coder.decode_single_token_bytes(i))
            held = Counter(owner[at : at + n])
            at += n
            if rule == "share":
                for k, v in held.items():
                    count[k] += v / n
            else:
                count[min(held) if rule == "start" else min(held, key=lambda k: (-held[k], k))] += 1
            crossing[min(held)] += len(held) > 1
        own = got[got["doc_id"] == r.doc_id].sort_values("section")
        assert np.allclose(own["n_tokens"], count) and own["n_crossing"].tolist() == crossing


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution_adds_up(spark, rule):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    got = attribution.attribute(docs, "doc_id", ["source", "lang", "text"], ("text",), rule).toPandas()
    encode = attribution.Lengths(attribution.default_path()).encoding.encode_ordinary
    for r in docs.collect():
        whole = f"{r.source}\n{r.lang}\n{r.text}"
        own = got[got["doc_id"] == r.doc_id].sort_values("section")
        assert abs(own["n_tokens"].sum() - len(encode(whole))) < 1e-6
        assert own["start"].tolist()[1:] == own["end"].tolist()[:-1] and own["end"].max() == len(whole)


def test_long_white_space_is_cut_as_the_pattern_cuts_it(monkeypatch):
    lengths = attribution.Lengths(attribution.default_path())
    texts = ["a" + w * n + b for w in (" ", "\n", "\t\u3000") for n in (1, 2, 3, 40) for b in ("", "b", " b", "\nb", "1", "\x1cb")]
    want = [lengths.encoding.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(attribution, "_RUN", re.compile(attribution._RUN.pattern.replace("10000", "2")))
    assert [lengths.ids(t) for t in texts] == want
    monkeypatch.undo()
    size, to = lengths.spans([" " * 2_000_000 + "x", "\n" * 2_000_000])
    assert size[: to[1]].sum() == 2_000_001 and size[to[1] :].sum() == 2_000_000


def test_allocate_rules():
    ends, sections = np.array([3, 10, 12]), np.array([4, 4, 9, 12])
    assert attribution.allocate(ends, sections, "start")[0].tolist() == [2, 0, 0, 1]
    assert attribution.allocate(ends, sections, "most")[0].tolist() == [1, 0, 1, 1]
    shared, crossing = attribution.allocate(ends, sections, "share")
    assert np.allclose(shared, [1 + 1 / 7, 0, 5 / 7, 1 / 7 + 1]) and crossing.tolist() == [1, 0, 0, 0]


def test_attribution_odd_rows(odd_docs, no_docs):
    got = attribution.attribute(odd_docs, "doc_id", ["source", "text"], ("text",))
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in odd_docs.collect()}
    assert attribution.attribute(no_docs, "doc_id", ["text"]).count() == 0
    with pytest.raises(ValueError):
        attribution.attribute(no_docs, "doc_id", ["text"], rule="none")


def brute_spans(text):
    found = [(*m.span(), "assign") for m in secrets.ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(*m.span(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(found + [(*m.span(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32])


def test_secret_spans(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    texts += ["PassWord='abcdefgh1' secret: token=short token=token=longenough", "AKIAKIA AKIAAKIA12345678ZZ", "İ token=12345678 ſecret=12345678", "a" * 40 + "F" + "0" * 31]
    for t in texts:
        assert sorted(s for s in secrets.spans(t) if s[2] in secrets.KINDS[:3]) == brute_spans(t)


def test_secret_query_matches_brute_force(spark):
    """All columns of the query: counts, the digest of the base spans, and the joined spans."""
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op8_secret_scan(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(got) == len(docs)
    order = ("assign", "access", "hex")
    for r in docs:
        base = sorted(brute_spans(r.text or ""), key=lambda s: (s[0], order.index(s[2])))
        joined = [f"{k}:{s}:{e}" for s, e, k in base]
        assert got[r.doc_id].base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert (got[r.doc_id].n_assign, got[r.doc_id].n_access, got[r.doc_id].n_hex) == tuple(sum(s[2] == k for s in base) for k in order)
        spans = got[r.doc_id].spans.split(",") if got[r.doc_id].spans else []
        assert [s for s in spans if s.split(":")[0] in order] == joined
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)


def test_secret_checksums():
    body = "A1b2C3d4E5f6G7h8J9k0L1m2N3p4Q5"
    n, tail = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, k = divmod(n, 62)
        tail = secrets.DIGITS[k] + tail
    good, bad = f"ghp_{body}{tail}", f"ghp_{body}{tail[::-1]}!"
    assert [s[2] for s in secrets.spans(f"x {good} y {bad}")] == ["github"]
    assert [s[2] for s in secrets.spans("card 4111 1111 1111 1111, card 4111 1111 1111 1112")] == ["card"]
    assert [s[2] for s in secrets.spans("IBAN: DE89 3704 0044 0532 0130 00. IBAN: DE88 3704 0044 0532 0130 00.")] == ["iban"]


def test_secret_odd_rows(odd_docs, no_docs):
    assert secrets.scan(odd_docs).count() == 11 and secrets.scan(no_docs).count() == 0


def read(df):
    return {r.conv_id: r for r in chat.read_back(df).collect()}


def test_chat_reads_back(spark):
    got = {r.conv_id: r for r in queries.op1_chat_windows(spark, SF).collect()}
    said = r"\### Assistant: </turn> ok"
    rows = [(r.conv_id, r.turn, r.role, r.text or "") for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()] + [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    for c in {r[0] for r in rows}:
        own = sorted(r for r in rows if r[0] == c)
        loss = "".join(t for _, _, role, t in own if role == "assistant")
        assert got[c].n_turns == len(own) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{role}\n{t}\n" for _, _, role, t in own).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def brute_windows(turns, budget, most):
    """(system, repeated, new) indices of turns by window, one turn at a time; turns: (role, tokens)."""
    out, system, past, now, used = [], None, [], None, 0
    for i, (role, n) in enumerate(turns):
        if now and used + n > budget:
            out, now = [*out, now], None
        if not now:
            now, room = ([], [], []), budget - n
            used = n
            if system is not None and (turns[system][1] <= room or room < 0):
                now[0].append(system)
                room -= turns[system][1]
                used += turns[system][1]
            room = min(most, room)
            for k in reversed(past):
                if turns[k][1] > room:
                    break
                now[1].insert(0, k)
                room -= turns[k][1]
                used += turns[k][1]
        else:
            used += n
        now[2].append(i)
        if role == "system" and system is None:
            system = i
        else:
            past.append(i)
    return [*out, now] if now else out


@pytest.mark.parametrize("system", [4, 60, 90, 130])
def test_chat_spans_match_brute_force(spark, system):
    """Budget 100: small and large system turns, turns over the budget, very long texts."""
    rng = np.random.default_rng(system)
    said = ["w " * int(n) for n in rng.choice([1, 5, 20, 60, 95, 150, 20000], 400, p=[0.2, 0.3, 0.3, 0.1, 0.05, 0.04, 0.01])]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(said)]
    rows[2] = (1, 2, "system", "s " * system)
    made = sorted(chat.windows(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"), 100, 0.3).collect(), key=lambda w: w.window)
    encode = attribution.Lengths(attribution.default_path()).encoding.encode_ordinary
    turns = [(r[2], len(encode(chat.format_turn(r[2], r[3])[0]))) for r in rows]
    want = brute_windows(turns, 100, 30)
    assert len(made) == len(want)
    for w, (kept, again, new) in zip(made, want, strict=True):
        assert [(r, t) for r, t, _, _ in chat.turns(w.text)] == [rows[k][2:] for k in (*kept, *again, *new)]
        assert w.new_from == len(kept) + len(again) and w.tokens == sum(turns[k][1] for k in (*kept, *again, *new))
        assert w.tokens <= 100 or max(turns[k][1] for k in new) > 100


def test_chat_windows(spark):
    rows = [(1, i, ("system", "user", "assistant")[0 if i == 0 else 1 + i % 2], f"turn {i} " + "w " * (200 if i % 7 == 3 else 30)) for i in range(200)]
    rows += [(None, 0, None, None), (2, 0, "a: b\\", "### x</turn>\n\\"), (2, 0, "a: b\\", "### x</turn>\n\\"), (2, None, "user:", "")]
    df = spark.createDataFrame([(*r, 7, "t") for r in rows], "conv_id long, turn int, role string, text string, TURN int, TEXT string")
    made = chat.windows(df, budget=150, history=0.5)
    windows = [r for r in made.collect() if r.conv_id == 1]
    assert len(windows) > 20
    new = []
    for w in sorted(windows, key=lambda r: r.window):
        inside = list(chat.turns(w.text))
        assert inside[0][0] == "system" and (w.tokens <= 150 or len(inside) == w.new_from + 1)
        new += inside[w.new_from :]
        assert [w.text[s.start : s.end] for s in w.loss] == [w.text[s:e] for r, _, s, e in inside[w.new_from :] if r == "assistant"]
    assert [t[1] for t in new] == [r[3] for r in rows[:200]]
    assert any(w.new_from > 1 for w in windows)
    back = read(made)
    assert back[2].n_turns == 3 and back[None].n_turns == 1
    assert read(chat.windows(df.where("false"))) == {}
