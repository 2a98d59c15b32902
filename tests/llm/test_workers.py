"""The operators on workers that cannot import the package, and on workers that lose tasks."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

ELSEWHERE = r'''
import importlib.util, json, sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
at = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1] + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(at)
at.loader.exec_module(entry)
found = spark.range(2, numPartitions=2).mapInArrow(
    lambda batches: (b for b in batches), "id bigint").count()  # workers that know nothing yet
out = {}
for name, query in entry.queries().items():
    if name.startswith("op"):
        out[name] = query(spark, "/root/testdata/sf0.001").count()
print(json.dumps(out))
'''

RETRY = r'''
import json, os, sys
sys.path.insert(0, REPO)
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[4,2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from cairn.llm import (exact_dedup, html_mincut, lang_bloom, mixing, orchard, paragraph_dedup,
                       piece_sampling, pitman_yor, queries, secret_scan, spelling, superminhash,
                       topk_nra, url_rules)
MARK = sys.argv[1]

def flaky(batches):
    from pyspark import TaskContext
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        open(os.path.join(MARK, f"fail-{ctx.stageId()}"), "w").close()
        raise RuntimeError("injected task failure")
    yield from batches

def table(name, key):
    df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    return df.repartition(4, key).sortWithinPartitions(key)

docs, pages, vectors = table("documents", "doc_id"), table("pages", "page_id"), table("embeddings", "vec_id")

def lm(d):
    d = d.select("doc_id", "text", lang_bloom.is_held_out("doc_id", 7, 2).alias("held_out"))
    return pitman_yor.score_texts(d, pitman_yor.fit(d))

def top(v):
    x = v.select(F.col("vec_id").alias("id"), topk_nra.quantized("embedding").alias("x"))
    return topk_nra.topk(x.where("id % 100 = 0"), x, 10)

vocabulary = piece_sampling.load_vocabulary()
OPS = {
    1: (docs, exact_dedup.exact_groups), 2: (pages, html_mincut.extract_pages),
    3: (docs, mixing.mix_plan), 4: (vectors, top),
    5: (docs, lambda d: lang_bloom.predict(d, lang_bloom.train(d))),
    6: (docs, lambda d: piece_sampling.sample_pieces(d, vocabulary)), 7: (docs, lm),
    8: (docs, superminhash.near_groups), 9: (docs, paragraph_dedup.repeated_spans),
    10: (docs, secret_scan.scan_secrets),
    11: (vectors, lambda v: orchard.cluster(v, F.sha2(F.col("vec_id").cast("string"), 256), 10, 2, 64)),
    12: (pages, lambda p: url_rules.judge_urls(p.select("page_id", "url"),
                                               url_rules.rule_frame(spark, queries.URL_RULES))),
    13: (docs, spelling.variant_groups),
}
out = {}
for n, (df, op) in OPS.items():
    before = len(os.listdir(MARK))
    good = sorted(map(repr, op(df).collect()))
    bad = sorted(map(repr, op(df.mapInArrow(flaky, df.schema)).collect()))
    out[n] = [len(good), good == bad, len(os.listdir(MARK)) - before]
print(json.dumps(out))
'''


def run(tmp_path, script, *args):
    path = tmp_path / "job.py"
    path.write_text(f"REPO = {REPO!r}\n" + script)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(path), *args], capture_output=True, text=True,
                         timeout=1200, cwd=tmp_path, env=env)
    assert out.returncode == 0, out.stderr[-3000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_operators_run_where_workers_lack_the_package(tmp_path):
    found = run(tmp_path, ELSEWHERE, REPO)
    assert {int(q[2:].split("_")[0]) for q in found} == set(range(1, 14))
    assert all(found.values())


def test_results_survive_task_retries(tmp_path):
    mark = tmp_path / "marks"
    mark.mkdir()
    found = run(tmp_path, RETRY, str(mark))
    assert set(found) == {str(n) for n in range(1, 14)}
    for n, (rows, same, failures) in found.items():
        assert rows and same and failures, (n, rows, same, failures)
