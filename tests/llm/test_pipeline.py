"""The pipeline against plain Python, and what happens when its folders are gone."""

import hashlib
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from test_lines_and_mix import plain_count, plain_lines
from test_simhash import components, plain_fingerprint

import corpus_pipeline
from tillwatch.llm import quality
from tillwatch.llm.lines import MIN_PAGES, RATIO
from tillwatch.llm.mixing import TEMPERATURE
from tillwatch.llm.queries import tokenizer

ROOT = Path(corpus_pipeline.__file__).parent


def documents():
    draw = random.Random(21)
    words = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(400)]
    rows, labels = [], []
    for i in range(160):
        text = "\n".join(" ".join(draw.choice(words) for _ in range(draw.randint(8, 40))) for _ in range(draw.randint(1, 5)))
        text = f"home about contact\n{text}" if i % 3 else text
        if i % 5 == 0:
            text = text.upper().replace(" ", "!! ")
        rows.append([i, text, draw.choice(["en", "de", None]), f"s{i % 3}" if i % 11 else None, len(text)])
        labels.append((i, 0 if i % 5 == 0 else 1, 0))
    for i in range(40):
        copy = list(rows[draw.randrange(160)])
        copy[0] = 500 + i
        if i % 2:
            copy[1] += " end"
        rows.append(copy)
    rows += [[900, "", "en", "s1", 0], [901, None, None, "s1", None]]
    return [tuple(r) for r in rows], labels


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, labels = documents()
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def plain_rest(rows):
    """Line dedup, near-duplicates, mix and encoding in plain Python, of rows that passed the classifier."""
    import base64

    import public_tokenizers
    import tiktoken

    path, pattern = tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    cleaned = {i: t for i, t, *_ in plain_lines([(r[0], r[1], r[3]) for r in rows], RATIO, MIN_PAGES)}
    rows = [(r[0], cleaned[str(r[0])], r[2], r[3]) for r in rows]
    group = components([plain_fingerprint(r[1]) for r in rows], [r[0] for r in rows])
    rows = [r for r, g in zip(rows, group) if r[0] == g]
    n = Counter(r[3] for r in rows)
    share = {s: c ** TEMPERATURE for s, c in n.items()}
    out = []
    for i, t, _, s in rows:
        rate = share[s] / sum(share.values()) * len(rows) / n[s]
        ids = coder.encode_ordinary(t or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        out += [(i, len(ids), digest, hashlib.sha256((t or "").encode()).hexdigest())] * plain_count(rate, i)
    return sorted(out)


def test_run_like_plain_python(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = quality.keep_good(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    rows = [tuple(r) for r in kept.collect()]
    good = {r[0] for r in documents()[0] if r[0] < 160 and r[0] % 5}
    assert len(good & {r[0] for r in rows}) >= 0.99 * len(good)
    assert len({r[0] for r in rows if r[0] < 160} - good) <= 3
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, tables).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == plain_rest(rows) and len(got) > 50


def test_stages_keep_the_columns_and_take_empty_tables(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tables).columns == docs.columns, name
        assert stage(spark, docs.limit(0), tables).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), tables).count() == 0


def test_entry_works_without_the_operators(tmp_path):
    code = ("import sys, builtins\n"
            "real = builtins.__import__\n"
            "def stop(name, *a, **k):\n"
            "    if name.startswith(('tillwatch.llm', 'corpus_pipeline')):\n"
            "        raise ModuleNotFoundError(name, name=name.split('.queries')[0])\n"
            "    return real(name, *a, **k)\n"
            "builtins.__import__ = stop\n"
            f"sys.path.insert(0, {str(ROOT)!r})\n"
            "import __spark_entry__ as e\n"
            "assert e.queries() and not [q for q in e.queries() if q == 'pipeline' or q.startswith('op')]\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)


def test_rest_of_the_library_does_not_import_the_operators():
    for path in (ROOT / "tillwatch").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(), path
