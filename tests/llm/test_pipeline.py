"""The whole pipeline against a plain Python version of its five stages."""

import collections
import math
import os

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import regex
import tiktoken

import corpus_pipeline
from shelfspark.llm import bpe, rule_ensemble

DATA = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")
WORD = regex.compile(r"[^\x20\x09-\x0D]+")
TERM = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The small tables, and planted rows: null, empty and short texts, repeats, near copies and benchmark passages."""
    to = tmp_path_factory.mktemp("tables")
    tables = {n: pq.read_table(f"{DATA}/{n}.parquet") for n in ("documents", "labels", "benchmark")}
    docs = tables["documents"].to_pylist()
    good = {r["doc_id"] for r in tables["labels"].to_pylist() if r["quality"] == 1}
    best = sorted((d for d in docs if d["doc_id"] in good and d["text"]), key=lambda d: -len(d["text"]))[:5]
    passage = max((r["text"] or "" for r in tables["benchmark"].to_pylist()), key=len)
    top = max(d["doc_id"] for d in docs) + 1
    planted = [None, "", " \n\t", "short text", "same words again and " * 30]
    for d in best:
        words = d["text"].split(" ")
        planted += [d["text"], " ".join([*words[:-1], "changed"]), " ".join([*words[:20], passage, *words[20:]])]
    # symbols that no rule counts are left to the classifier
    planted += [" • ".join(d["text"].split(" ")) for d in best]
    docs += [dict(docs[0], doc_id=top + i, text=t) for i, t in enumerate(planted)]
    docs += [docs[3], docs[3], dict(docs[4], doc_id=None)]
    tables["documents"] = pa.Table.from_pylist(docs, tables["documents"].schema)
    for name, table in tables.items():
        pq.write_table(table, f"{to}/{name}.parquet")
    return str(to)


def keeps_rules(text):
    words = WORD.findall(text or "")
    n, chars = len(words), sum(map(len, words))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(n - 4)]
    times = collections.Counter(windows)
    repeated = len({i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)})
    symbols, capitals = (sum(c in some for c in text or "") for some in ("#*$%&|<>", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    twice = len(lines) - len(set(lines))
    return not (
        n < 10 or 100 * repeated > 20 * n or 100 * symbols > 20 * n or (len(lines) >= 4 and 100 * twice > 30 * len(lines))
        or not 2 * n <= chars <= 20 * n or 100 * capitals > 40 * chars
    )


def quality(text, model):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, chars = len(words), sum(map(len, words))

    def ratio(a, b):
        return a / b if b else 0.0

    def seen(pattern):
        return len(regex.findall(pattern, text))

    value = {
        "symbol_ratio": ratio(seen(r"[^\p{L}\p{N}\p{M} \t\n\x0b\f\r.,;:!?'\"()\-]"), n),
        "bang_ratio": ratio(seen("[!?]"), n),
        "capital_ratio": ratio(seen(r"\p{Lu}"), chars),
        "digit_ratio": ratio(seen("[0-9]"), chars),
        "distinct_ratio": ratio(len(set(words)), math.sqrt(n)),
        "mean_word": ratio(chars, n),
        "line_words": ratio(n, len(lines)),
        "repeated_lines": ratio(len(lines) - len(set(lines)), len(lines)),
        "stop_ratio": ratio(sum(bool(regex.fullmatch(r"\p{L}{1,3}", w)) for w in words), n),
        "log_words": math.log1p(n),
    }
    z = model.intercept
    for rule, weight in model.weighted:
        if all(value[name] <= bound if op == "<=" else value[name] > bound for name, op, bound in rule.bounds):
            z += weight
    return 1 / (1 + math.exp(-z))


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def one_of_each(docs):
    """Rows in order of (null id last, id); a row that links to an earlier one of its component goes."""
    docs = sorted(docs, key=lambda d: (d["doc_id"] is None, d["doc_id"] or 0))
    sets = [shingles(d["text"]) for d in docs]
    comp = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and comp[a] != comp[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((comp[a], comp[b]))
                comp = [low if c == high else c for c in comp]
    return [d for i, d in enumerate(docs) if comp[i] == i]


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def clean_of(docs, items):
    windows = set()
    for item in items:
        words = terms(item["text"])
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()
    sizes = {len(w) for w in windows}

    def hit(text):
        words = terms(text)
        return any(tuple(words[i : i + s]) in windows for s in sizes for i in range(len(words) - s + 1))

    return [d for d in docs if not hit(d["text"])]


def test_pipeline_equals_brute_force(spark, folder, monkeypatch):
    models = []
    train = rule_ensemble.train
    monkeypatch.setattr(rule_ensemble, "train", lambda *a, **k: models.append(train(*a, **k)) or models[-1])
    got = collections.Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.round_trip) for r in corpus_pipeline.run(spark, folder).collect())

    steps = [pq.read_table(f"{folder}/documents.parquet").to_pylist()]
    steps.append([d for d in steps[-1] if keeps_rules(d["text"])])
    steps.append([d for d in steps[-1] if quality(d["text"], models[0]) >= corpus_pipeline.QUALITY_LEAST])
    steps.append(one_of_each(steps[-1]))
    steps.append(clean_of(steps[-1], pq.read_table(f"{folder}/benchmark.parquet").to_pylist()))
    sizes = [len(s) for s in steps]
    assert sizes == sorted(set(sizes), reverse=True)  # every stage rejects something

    ranks = bpe.Encoder(open(public_tokenizers.path(corpus_pipeline.RANKS), "rb").read(), public_tokenizers.PATTERN).v.ranks
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [(d["doc_id"], own.encode_ordinary(d["text"])) for d in steps[-1]]
    assert got == collections.Counter((i, len(t), b"".join(x.to_bytes(4, "little") for x in t), True) for i, t in ids)


def test_pipeline_of_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        pq.write_table(pq.read_table(f"{folder}/{name}.parquet").slice(0, 0), f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema.names == docs.columns, name
