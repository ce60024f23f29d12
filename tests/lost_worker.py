"""Run by test_faults: ingest and search with Python workers that die once each."""

import json
import os
import sys
from dataclasses import dataclass
from pathlib import Path

import numpy as np

from tests.support import SF
from wellspring.plans.answer import answer_batch, encode_questions
from wellspring.plans.ingest import ingest
from wellspring.session import local_session
from wellspring.sources.articles import article_scan, batches
from wellspring.sources.questions import questions
from wellspring.workspace import scratch, stage


def die_once(marker: str) -> None:
    try:
        os.close(os.open(marker, os.O_CREAT | os.O_EXCL))
    except FileExistsError:
        return
    os._exit(1)


@dataclass(frozen=True)
class Encoder:
    folder: str

    def __call__(self):
        def run(texts):
            die_once(f"{self.folder}/encoder-{len(texts) > 30}")
            return np.array([[len(t), ord(t[0]), t.count("e")] for t in texts], dtype=np.float32)

        return run


@dataclass(frozen=True)
class Generator:
    folder: str

    def __call__(self):
        def run(system, user):
            die_once(f"{self.folder}/generator")
            return str(len(user))

        return run


def main(folder: str) -> None:
    spark = local_session("lost-worker", **{"spark.checkpoint.dir": f"{folder}/shared"})
    marks = f"{folder}/marks"
    docs = batches(article_scan(spark, f"{SF}/documents.parquet", title="source"), 70)
    index = ingest(docs, scratch(spark, "t"), Encoder(marks), 3)
    asked = encode_questions(
        questions(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id", "text"), Encoder(marks)
    )
    answers = stage(answer_batch(index, asked, Generator(marks)), "t").orderBy("query_id").collect()
    positions = index.positioned().orderBy("pos").collect()
    out = {
        "deaths": sorted(p.name for p in Path(marks).iterdir()),
        "answers": [[r.query_id, r.answer, r.status, r.indices, r.distances] for r in answers],
        "positions": [[r.pos, r.chunk_id, r.embedding] for r in positions],
    }
    Path(folder, "out.json").write_text(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
