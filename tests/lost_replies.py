"""Run by test_replies: a generator that kills its worker half-way, once, and counts its calls."""

import os
import sys
from dataclasses import dataclass

from tests.lost_worker import die_once
from tests.support import small_index
from wellspring.plans.answer import answer_batch, encode_questions
from wellspring.session import local_session
from wellspring.workspace import ship_package, stage


@dataclass(frozen=True)
class Letters:
    def __call__(self):
        import numpy as np

        return lambda texts: np.array([[len(t), ord(t[-1])] for t in texts], np.float32)


@dataclass(frozen=True)
class Counting:
    folder: str
    deadly: bool = True

    def __call__(self):
        def run(system, user):
            asked = user.rsplit("Question: ", 1)[1].split("\n")[0]
            if self.deadly and asked.startswith("q7 "):
                die_once(f"{self.folder}/died")
            with open(f"{self.folder}/calls-{os.getpid()}", "a") as calls:
                calls.write(asked + "\n")
            return f"to {asked}"

        return run


def main(folder: str) -> None:
    spark = local_session("lost-replies", **{"spark.checkpoint.dir": f"{folder}/shared"})
    ship_package(spark)
    index = small_index(spark, [(0, 0, "text", [1.0, 2.0])], 2)
    rows = [(f"i{i}", f"q{i} ?") for i in range(40)]
    asked = encode_questions(spark.createDataFrame(rows, "query_id string, query_text string"), Letters())
    for _ in range(2):  # the second run finds all replies
        answers = answer_batch(index, asked, Counting(folder), slices=2, ledger=f"{folder}/ledger")
        out = stage(answers, "t").select("query_id", "answer", "status").collect()
        assert len(out) == 40 and all(r.status == "completed" and r.answer.startswith("to q") for r in out)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
