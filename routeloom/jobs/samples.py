"""Prefix samples of the clean table."""

from __future__ import annotations

from ..plans.samples import write_samples
from ..session import open_session
from .common import arguments, show


def main() -> None:
    args = arguments(__doc__, "input", "output-root").parse_args()
    spark = open_session("routeloom-samples")
    for sample in write_samples(spark, args.input, args.output_root):
        show(sample)
    spark.stop()


if __name__ == "__main__":
    main()
