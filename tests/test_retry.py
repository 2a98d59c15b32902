"""Task retries give the same results (executors can be lost at any time).

Runs in a child process with its own local[4,2] session (tasks may fail once): the input goes
through a stage whose first attempt of partition 0 fails in every job, so every k-median round
and both word-count levels are retried at least once.
"""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r'''
import json, os, sys
sys.path.insert(0, REPO)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4,2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from cairn.sources import tables
from cairn.operators import kmedian, wordcount

MARK = sys.argv[1]

def flaky(batches):
    from pyspark import TaskContext
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        open(os.path.join(MARK, f"fail-{ctx.stageId()}"), "w").close()
        raise RuntimeError("injected task failure")
    yield from batches

SF = "/root/testdata/sf0.01"
pts = tables.embedding_points(spark, SF).repartition(4, "id")
bad = pts.mapInArrow(flaky, pts.schema)
a = kmedian.coreset_kmedian(pts, 4, 3, 2, 7, persist=False)
b = kmedian.coreset_kmedian(bad, 4, 3, 2, 7, persist=False)
docs = tables.documents(spark, SF).repartition(4, "doc_id")
wa = {r.word: r.n for r in wordcount.word_count_salted(docs, 8, 3).collect()}
wb = {r.word: r.n for r in wordcount.word_count_salted(docs.mapInArrow(flaky, docs.schema), 8, 3).collect()}
print(json.dumps({"obj": [a.objective, b.objective],
                  "coreset": [[r[:2] + (r[3],) for r in a.coreset], [r[:2] + (r[3],) for r in b.coreset]],
                  "words_equal": wa == wb, "n_words": len(wa),
                  "failures": len(os.listdir(MARK))}))
'''


def test_results_survive_task_retries(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(f"REPO = {REPO!r}\n" + SCRIPT)
    mark = tmp_path / "marks"
    mark.mkdir()
    out = subprocess.run([sys.executable, str(script), str(mark)], capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    res = json.loads(out.stdout.strip().splitlines()[-1])
    assert res["failures"] >= 5          # several jobs really lost a task
    assert res["obj"][0] == res["obj"][1]
    assert res["coreset"][0] == res["coreset"][1]
    assert res["words_equal"] and res["n_words"] > 0
