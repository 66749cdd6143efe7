"""Raw CSV to the clean table, as Parquet and as CSV."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.quality import require_zero
from ..plans.clean import KEPT, PART, account_parts, parted
from ..schemas import CLEAN_SCHEMA
from ..session import open_session
from ..sinks.files import publish_csv
from ..sources.files import read_parquet, read_raw_csv
from ..sources.published import Folder, publish
from .common import arguments, show

# the folder of the rows that are kept
KEPT_FOLDER = f"{PART}={KEPT}"
# Plain text is about eight times the Parquet copy; CSV readers take these files as they are.
TEXT_CODEC = "gzip"


def run(
    spark: SparkSession, source: str, parquet_path: str, csv_path: str, codec: str = TEXT_CODEC
) -> dict:
    """Read the text once: write all typed rows in a folder per part, count them, publish.

    The counts come from the footers of what was written. The folder of the kept rows counts
    only when the gates hold, so that earlier output survives. The text copy is made from
    the Parquet copy, in files packed with ``codec``.
    """
    counts = {}

    def write(place: str) -> None:
        rows = parted(read_raw_csv(spark, source))
        rows.write.partitionBy(PART).parquet(place)
        if KEPT_FOLDER not in Folder(spark, place).names():
            spark.createDataFrame([], CLEAN_SCHEMA).write.parquet(f"{place}/{KEPT_FOLDER}")
        counts.update(account_parts(spark.read.schema(rows.schema).parquet(place)).first().asDict())

    def check(_: str) -> None:
        require_zero({name: counts[name] for name in ("null_key_rows", "diverted_rows")})

    publish(spark, parquet_path, write, check, inner=KEPT_FOLDER)
    publish_csv(read_parquet(spark, parquet_path), csv_path, codec)
    return counts


def main() -> None:
    parser = arguments(__doc__, "input", "parquet-output", "csv-output")
    parser.add_argument("--csv-codec", default=TEXT_CODEC, help="none: plain text")
    args = parser.parse_args()
    spark = open_session("routeloom-clean")
    show(run(spark, args.input, args.parquet_output, args.csv_output, args.csv_codec))
    spark.stop()


if __name__ == "__main__":
    main()
