"""Compare two Parquet tables as multisets of rows; fails if they differ."""

from __future__ import annotations

from ..operators.compare import compare_by_digest, require_same
from ..session import open_session
from ..sources.files import read_parquet
from .common import arguments, show


def main() -> None:
    parser = arguments(__doc__, "left", "right")
    parser.add_argument("--left-label", default="left")
    parser.add_argument("--right-label", default="right")
    args = parser.parse_args()
    spark = open_session("routeloom-compare")
    left, right = read_parquet(spark, args.left), read_parquet(spark, args.right)
    show(require_same(left, right, args.left_label, args.right_label, compare_by_digest))
    spark.stop()


if __name__ == "__main__":
    main()
