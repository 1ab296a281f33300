"""Chat formatting, token files, WARC, mixing, and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import chat, common, decontamination, jaccard_join, langid, mixing, pfor, token_files, warc

SF = "/root/testdata/sf0.001"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|>[]/\\sINTSY_abc \n", max_size=40))
def test_escape_is_reversible_and_hides_controls(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROL)
    body, a, b = chat.render_turn(text, text)
    assert list(chat.parse_turns(body + body)) == [(text, text)] * 2 and chat.unescape(body[a:b]) == text


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, event string, message string, role string, text string")


def test_events_fold_into_final_messages(spark):
    rows = [
        (1, 0, "message", "u1", "user", "hi"), (1, 1, "delta", "a1", "assistant", "He"), (1, 2, "delta", "a1", None, "llo"), (1, 3, "edit", "u1", None, "hi!"),
        (1, 4, "message", "u2", "user", "more"), (1, 5, "delta", "a2", "assistant", "bad"), (1, 6, "regenerate", "a1", None, "Good"), (1, 7, "delta", "a1", None, " day"),
        (2, 0, "message", None, "user", None), (2, 1, "delta", None, "assistant", "x"), (None, 0, "message", None, None, "no id"),
    ]
    out = {r.conv_id: r for r in chat.format_conversations(events(spark, rows)).collect()}
    assert list(chat.parse_turns(out[1].formatted)) == [("user", "hi!"), ("assistant", "Good day")]
    assert list(chat.parse_turns(out[2].formatted)) == [("user", "x")] and list(chat.parse_turns(out[None].formatted)) == [("", "no id")]
    assert chat.format_conversations(events(spark, []).limit(0)).collect() == []


def _folded(log):
    """A log's final messages, by going through all messages for every event."""
    out = []
    for event, key, role, text in log:
        own = [i for i, m in enumerate(out) if key is not None and m[0] == key][-1:]
        if event == "delta" and key is None and out:
            own = [len(out) - 1]
        if own and event == "delta":
            out[own[0]][2] += text
        elif own and event == "edit":
            out[own[0]][2] = text
        else:
            if own and event == "regenerate":
                role, out = role or out[own[0]][1], out[: own[0]]
            out.append([key, role, text])
    return [(m[1], m[2]) for m in out]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["message", "delta", "edit", "regenerate"]), st.sampled_from([None, "a", "b", "c"]), st.sampled_from(["user", "assistant", ""]), st.text(max_size=3)), max_size=25))
def test_fold_equals_a_plain_walk(log):
    fold = chat.Fold()
    got = [m for e in log for m in fold.add(*e)]
    assert [*got, *fold.end()] == _folded(log)


def test_chat_query_reads_back_all_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 300)
    rows = [(c, t, ("user", "assistant", "system")[t % 3], f"<|x|> \\ {c} {t} " * (t % 5)) for c in range(20) for t in range(c)] + [(5, 3, "user", None)]
    log = spark.createDataFrame(rows, "conv_id long, seq long, role string, text string").withColumns({"event": F.lit("message"), "message": F.lit(None).cast("string"), "part": F.lit(1)})
    got = {r.conv_id: r for r in chat.read_conversations(chat.format_conversations(log)).collect()}
    for c in range(1, 20):
        own = sorted((t, r, x or "") for k, t, r, x in rows if k == c)
        if c == 5:
            own.sort(key=lambda x: (x[0], x[1], x[2] != ""))
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[c].n_turns == len(own) and got[c].loss_chars == len(loss) and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
    probe = chat.op6_chat_format(spark, SF).where("conv_id = -7").first()
    assert probe.n_turns == 2 and probe.loss_chars == len("</s>[INST] ok [/INST]")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=700), st.sampled_from([0.5, 0.9, 1.0]))
def test_pfor_round_trip(values, percentile):
    v = np.array(values, np.uint32)
    reader = pfor.Reader(pfor.encode(v, percentile))
    assert (reader.values() == v).all() and len(reader) == len(v)
    assert (reader.values(len(v) // 3, len(v) // 2) == v[len(v) // 3 : len(v) // 2]).all()


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    texts = ["Hello, World's end. É 12", None, "", "a <|endoftext|> b", "x" * 5000 + " " + "word " * 3000, "Hello, World's end. É 12"]
    rows = [(i // 2 * 3 if i != 1 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x"))
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.token_documents(df.repartition(3)).collect()))
    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts}
    want = sorted((d if d is not None else -1, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for d, t in rows)
    assert sorted((d if d is not None else -1, n, c) for _, d, n, c in got) == want
    assert [s for s, *_ in got] == np.cumsum([0, *[n for _, _, n, _ in got][:-1]]).tolist()
    assert [d for _, d, *_ in got] == [None, 0, 3, 3, 6, 6]
    assert token_files.token_documents(df.limit(0)).collect() == []


def test_token_query_equals_a_direct_encoding(spark):
    docs = common.table(spark, SF, "documents")
    want = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.op7_token_files(spark, SF).collect()}
    tokenizer, start = token_files._tokenizer(token_files.default_tokenizer())[0], 0
    for r in docs.orderBy("doc_id").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        assert want[r.doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_one_task_writes_several_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_IDS", 300)
    monkeypatch.setattr(token_files, "SLICE", 200)
    monkeypatch.setattr(token_files.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 7})())
    texts = [f"word{i} " * (i % 40) for i in range(100)]
    batch = pa.record_batch([pa.array(range(100), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    write = token_files._write_shards(f"file://{tmp_path}", token_files.default_tokenizer(), 2, 0.9)
    (manifest,) = write(iter([batch.slice(0, 50), batch.slice(50)]))
    assert manifest.num_rows > 5 and sum(manifest.column("docs").to_pylist()) == 100
    keys, ids = [], []
    for path in manifest.column("path").to_pylist():
        own, counts, reader = token_files.read_shard(path)
        edges = np.concatenate([[0], np.cumsum(counts)])
        keys += own.to_pylist()
        ids += [reader.values(int(a), int(b)).tolist() for a, b in zip(edges[:-1], edges[1:])]
    tokenizer = token_files._tokenizer(token_files.default_tokenizer())[0]
    assert keys == list(range(100)) and ids == [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_another_tokenizer_encodes_whole_texts():
    import public_tokenizers

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["Two  spaces, Capitals\n\tand tabs", "", " leading", None]
    ids, per = token_files.encode_texts(pa.array(texts), path)
    tokenizer, by_words = token_files._tokenizer(path)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert not by_words and token_files._tokenizer(token_files.default_tokenizer())[1]
    assert per.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_sliced_columns_encode_the_same():
    texts = pa.array([f"Ünïcode {i} wörds, né! don't" * (i % 7) for i in range(200)])
    whole, n = token_files.encode_texts(texts, token_files.default_tokenizer())
    from textloom.llm.shingles import slices

    parts = [token_files.encode_texts(p.column("t"), token_files.default_tokenizer()) for p in slices(pa.record_batch([texts], names=["t"]), "t", 500)]
    assert len(parts) > 5 and (np.concatenate([p[0] for p in parts]) == whole).all() and (np.concatenate([p[1] for p in parts]) == n).all()


def records(n):
    return [warc.page_record(i, f"http://x/{i}", b"payload %d " % i * 50, i, True) for i in range(n)]


@pytest.mark.parametrize("pack", [lambda r: r, warc.member])
def test_salvage_skips_only_the_damage(pack):
    parts = [pack(r) for r in records(6)]
    damaged = bytearray(parts[2])
    damaged[len(damaged) // 2] ^= 0xFF
    data = parts[0] + parts[1] + bytes(damaged) + b"junk WARC/1.9\r\n" + parts[3] + parts[4][: len(parts[4]) // 2] + parts[5]
    got = list(warc.salvage(io.BytesIO(data)))
    ids = [x.headers["warc-record-id"] for x in got if isinstance(x, warc.Record)]
    assert ids == [f"<urn:page:{i}>" for i in (0, 1, 3, 5)]
    gaps = [(x.start, x.end) for x in got if isinstance(x, warc.Gap)]
    at = len(parts[0]) + len(parts[1])
    first = at + len(damaged) + len(b"junk WARC/1.9\r\n")
    second = first + len(parts[3])
    assert gaps == [(at, first), (second, second + len(parts[4]) // 2)]


def test_salvage_finds_a_member_at_the_windows_end():
    parts = [warc.member(warc.page_record(i, f"http://x/{i}", np.random.default_rng(i).bytes(5000), i, True)) for i in range(3)]
    junk = b"-" * (2 * warc.WINDOW - 100)
    gap, *got = warc.salvage(io.BytesIO(junk + b"".join(parts)))
    assert (gap.start, gap.end) == (0, len(junk))
    assert [x.headers["warc-record-id"] for x in got] == [f"<urn:page:{i}>" for i in range(3)]


def _ids(found):
    return [x.headers.get("warc-record-id") for x in found if isinstance(x, warc.Record)]


@pytest.mark.parametrize("pack", [lambda r: r, warc.member])
def test_headers_of_any_length(pack):
    urls = ["u", "v" * 70_000, "w" * 3_000_000, "x"]
    data = b"".join(pack(warc.page_record(i, u, b"payload", i, True)) for i, u in enumerate(urls))
    got = list(warc.salvage(io.BytesIO(data)))
    assert [x.headers["warc-target-uri"] for x in got] == urls


def test_pages_with_long_urls_are_read_back(spark):
    rows = [(1, "a" * 70_000, "one"), (2, "b" * 200_000, "two"), (3, "c", "one")]
    manifest = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), common.Scratch(spark, "test").folder("long"))
    assert sorted(r.id for r in warc.read_archives(manifest).where("type <> 'warcinfo'").collect()) == [f"<urn:page:{i}>" for i in (1, 2, 3)]


def test_salvage_passes_nested_members_over_several_windows():
    """A plain record that is damaged and holds gzip members in every window, and records after it."""
    rng = np.random.default_rng(1)
    inner = b"".join(warc.member(b"no record " + rng.bytes(3000)) + rng.bytes(700) for _ in range(900))
    assert len(inner) > 3 * warc.WINDOW
    outer = warc.page_record(0, "u", inner, 0, True).replace(b"Content-Length: ", b"Content-Length: 9", 2)
    rest = [warc.page_record(i, "u", b"x" * 50, i, True) for i in (1, 2)]
    gap, *got = warc.salvage(io.BytesIO(outer + b"".join(rest)))
    assert _ids(got) == ["<urn:page:1>", "<urn:page:2>"] and (gap.start, gap.end) == (0, len(outer))


class _Pipe(io.BytesIO):
    def seekable(self):
        return False


@pytest.mark.parametrize("pack", [lambda r: r, warc.member])
def test_damage_at_every_offset_loses_one_record_at_most(pack):
    parts = [pack(warc.page_record(i, f"http://x/{i}", b"payload %d" % i, i, True)) for i in range(4)]
    clean, at, end = b"".join(parts), len(parts[0]), len(parts[0]) + len(parts[1])
    for offset in range(at, end):
        data = bytearray(clean)
        data[offset] ^= 0x5A
        got = list(warc.salvage((io.BytesIO if offset % 2 else _Pipe)(bytes(data))))
        ids = _ids(got)
        assert set(ids) >= {f"<urn:page:{i}>" for i in (0, 2, 3)}, offset
        # records and gaps cover the archive, in order
        edges = [(x.start, x.end) for x in got]
        assert edges[0][0] == 0 and edges[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
    cut = list(warc.salvage(io.BytesIO(clean[: end - 3])))
    assert _ids(cut) == ["<urn:page:0>"] and cut[-1].end == end - 3


def test_archive_query_equals_direct_digests(spark):
    pages = common.table(spark, SF, "pages").collect()
    first = {}
    for r in sorted(pages, key=lambda r: r.page_id):
        first.setdefault(r.html or "", r.page_id)
    want = []
    for r in pages:
        body, ref = (r.html or "").encode(), first[r.html or ""]
        want.append((r.page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if ref == r.page_id else "revisit", None if ref == r.page_id else ref))
    assert sorted(want, key=str) == sorted((tuple(r) for r in warc.op8_warc(spark, SF).collect()), key=str)


def test_salvage_of_nothing_and_of_a_cut_end():
    assert list(warc.salvage(io.BytesIO(b""))) == []
    (gap,) = warc.salvage(io.BytesIO(b"no archive at all"))
    assert (gap.start, gap.end) == (0, 17)
    data = warc.member(records(1)[0])
    record, gap = warc.salvage(io.BytesIO(data + data[:-9]))
    assert record.payload.startswith(b"payload 0") and (gap.start, gap.end) == (len(data), 2 * len(data) - 9)


def test_archives_round_trip(spark):
    rows = [(5, "u", "same"), (3, "u", "same"), (9, None, "same"), (1, "v", None), (2, "v", ""), (4, "w\r\nx", "é" * 100000), (7, "z", "once"), (None, "z", "same")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, first int")
    scratch = common.Scratch(spark, "test")
    manifest = warc.write_archives(pages.repartition(2), scratch.folder("a"), max_bytes=200)
    got = {r.id: r for r in warc.read_archives(manifest, with_payload=True).where("type in ('response', 'revisit')").collect()}
    assert len(got) == len(rows) and manifest.count() >= 3
    first = {"same": 3, "": 1, "once": 7, "é" * 100000: 4}
    for i, _, html in rows:
        r, html = got[f"<urn:page:{i}>"], html or ""
        assert r.payload_bytes == len(html.encode()) and r.digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        if first[html] == i:
            assert r.type == "response" and bytes(r.payload).decode() == html
        else:
            assert r.type == "revisit" and r.refers_to == f"<urn:page:{first[html]}>"
    assert warc.read_archives(warc.write_archives(pages.limit(0), scratch.folder("b"))).collect() == []
    few = warc.read_archives(warc.write_archives(pages, scratch.folder("c"), min_bytes=5)).where("type = 'revisit'")
    assert few.count() == 0


def test_mix_meets_its_targets(spark):
    rows = [(s * 10000 + i, "w " * (1 + (i * 7919) % 50), f"s{s}") for s, n in enumerate([400, 300, 900]) for i in range(n)]
    rows += [(99991, None, None), (99992, "a b c", None), (99992, "a b c", None), (99993, " ", "empty")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix(df, bucket_rows=64).collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted((d, len((t or "").split())) for d, t, _ in rows)
    by = {}
    for r in got:
        x = by.setdefault(r.source, [0, 0.0, 0])
        x[0], x[1], x[2] = x[0] + r.taken, r.target, x[2] + r.size
        assert r.taken <= 2 * r.size and r.source_size >= r.size
    total = sum(x[2] for x in by.values())
    assert all(abs(taken - target) <= 3 and target <= 2 * size + 1e-9 for taken, target, size in by.values())
    assert sum(x[1] for x in by.values()) == pytest.approx(1.5 * total)
    again = mixing.mix(df.repartition(5), bucket_rows=64).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)
    mixed = mixing.mixed_documents(df, bucket_rows=64)
    assert mixed.columns == df.columns and sum(x[0] for x in by.values()) == sum(len((r.text or "").split()) for r in mixed.collect())
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.mixed_documents(df.limit(0)).collect() == []


def test_mix_of_documents_hits_its_targets(spark):
    """sf0.01: each source of some dozen documents; longer classes are taken more often, and no class always alike."""
    got = mixing.op9_pareto_mix(spark, "/root/testdata/sf0.01").withColumn("miss", F.lit(0)).toPandas()
    by = got.groupby(["source_size", "target"]).agg(taken=("taken", "sum"), n=("taken", "size")).reset_index()
    assert ((by.taken - by.target).abs() <= 0.01 * by.target).all()
    odds = got[got["size"] > 0].assign(long=lambda d: d["size"] > d["size"].median()).groupby("long").copies.mean()
    assert odds[True] > odds[False]


def test_mix_keeps_every_row_of_repeated_ones(spark):
    rows = [(1, "w " * 9, "s", "x"), (1, "w " * 9, "s", "y")] + [(10 + i, "v " * 9, "t", "z") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy string").withColumn("mix_id", F.lit(1))
    mixed = mixing.mixed_documents(df, weights=(100, 1)).where("doc_id = 1").collect()
    assert sorted(r.copy for r in mixed) == ["x", "x", "y", "y"] and mixed[0].mix_id == 1


def test_pipeline_stages_equal_their_operators(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontaminate", "mix", "token_files"]
    docs = common.table(spark, SF, "documents")
    items = common.table(spark, SF, "benchmark")
    scratch = common.Scratch(spark, "stages")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        steps[name] = docs = scratch.table(stage(spark, docs, SF), name)
        assert name == "token_files" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    source = common.table(spark, SF, "documents")
    found = langid.identify(source, langid.learn(langid.training_rows(source)))
    assert ids(steps["language_id"]) == ids(found.where("lang_pred <> 'und' and score >= 0.5")) and len(ids(steps["language_id"])) > 0.97 * source.count()
    joined = jaccard_join.jaccard_join(steps["language_id"], width=5, percent=80)
    assert ids(steps["jaccard_join"]) == sorted({r.component_id for r in joined.collect()})
    bad = {r.doc_id for r in decontamination.contained_items(steps["jaccard_join"], items).collect()}
    assert ids(steps["decontaminate"]) == [i for i in ids(steps["jaccard_join"]) if i not in bad] and bad
    drawn = {r.doc_id: r.copies for r in mixing.mix(steps["decontaminate"]).collect()}
    assert ids(steps["mix"]) == sorted(i for i, n in drawn.items() for _ in range(n))
    assert ids(steps["token_files"]) == ids(steps["mix"])
    assert corpus_pipeline.run(spark, SF).count() == steps["token_files"].count()
