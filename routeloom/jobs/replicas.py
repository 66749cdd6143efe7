"""The clean table once, twice and four times over."""

from __future__ import annotations

from ..plans.samples import write_replicas
from ..session import open_session
from .common import arguments, show


def main() -> None:
    args = arguments(__doc__, "input", "output-root").parse_args()
    spark = open_session("routeloom-replicas")
    for replica in write_replicas(spark, args.input, args.output_root):
        show(replica)
    spark.stop()


if __name__ == "__main__":
    main()
