"""Command line: ``python -m trafficlens <job> ...`` (see ``plans/jobs.py``).

    extract   CAPTURE_ROOT OUT [--percent P] [--compat] [--classes A,B] [--extended]
    profile   TABLE [--classes A,B]
    train     TABLE [--model decision_tree|random_forest|perceptron] [--nulls skip]
              [--results PATH] [--model-out PATH] [--matrix-out PATH] [--classes A,B]
    inventory ROOT

The session comes from the environment (``spark-submit`` settings); run
locally it uses ``local[*]``.
"""

from __future__ import annotations

import argparse

from .plans import jobs
from .session import build_session


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="trafficlens")
    sub = p.add_subparsers(dest="job", required=True)
    e = sub.add_parser("extract")
    e.add_argument("capture_root")
    e.add_argument("out")
    e.add_argument("--percent", type=int, default=100)
    e.add_argument("--compat", action="store_true")
    e.add_argument("--extended", action="store_true")
    e.add_argument("--classes")
    pr = sub.add_parser("profile")
    pr.add_argument("table")
    pr.add_argument("--classes")
    t = sub.add_parser("train")
    t.add_argument("table")
    t.add_argument("--model", default="decision_tree")
    t.add_argument("--nulls", default="skip")
    t.add_argument("--results")
    t.add_argument("--model-out")
    t.add_argument("--matrix-out")
    t.add_argument("--classes")
    i = sub.add_parser("inventory")
    i.add_argument("root")
    a = p.parse_args(argv)
    classes = a.classes.split(",") if getattr(a, "classes", None) else None
    from pyspark.sql import SparkSession
    active = SparkSession.getActiveSession()
    spark = active or build_session(None)
    if a.job == "extract":
        jobs.extract(spark, a.capture_root, a.out, a.percent, a.compat, classes, a.extended) \
            .groupBy("class_name").count().show(truncate=False)
    elif a.job == "profile":
        prof, box = jobs.profile(spark, a.table, classes)
        prof.show()
        box.orderBy("feature").show(truncate=False)
    elif a.job == "train":
        jobs.train(spark, a.table, a.model, classes, a.nulls, a.results, a.model_out, a.matrix_out).show(truncate=False)
    elif a.job == "inventory":
        jobs.inventory(spark, a.root).orderBy("dir").show(truncate=False)


if __name__ == "__main__":
    main()
