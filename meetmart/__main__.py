from __future__ import annotations

import logging
import sys

from meetmart.config import RunConfig
from meetmart.plans.jobs import JOBS
from meetmart.session import build_session, sized_for
from meetmart.sources import scratch


def main(argv: list[str]) -> None:
    if not argv or argv[0] not in JOBS:
        raise SystemExit(f"usage: python -m meetmart {{{','.join(JOBS)}}} key=value ...")
    logging.basicConfig(level=logging.INFO)
    cfg = RunConfig.from_args(argv[1:])
    spark = build_session(f"meetmart-{argv[0]}", **(sized_for(cfg.input_gb) if cfg.input_gb else {}))
    try:
        JOBS[argv[0]](spark, cfg)
    finally:
        scratch.clear(spark)
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
