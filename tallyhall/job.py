"""The whole run as a Spark job: raw files in, cleaned tables, log, results and figures out.

    spark-submit tallyhall/job.py RAW_DIR OUT_DIR --lexicon LEXICON_FILE [--modifiers MODIFIER_FILE] [--phrases PHRASE_FILE]
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyhall.plans import suite  # noqa: E402
from tallyhall.sources import readers  # noqa: E402

# The public datasets' file names. A folder or pattern of files works as well.
FILES = {
    "behavior": "UserBehavior.csv",
    "listings": "listings_detailed.csv.gz",
    "listing_reviews": "reviews_detailed.csv.gz",
    "reviews": "yelp_reviews.csv",
    "comments": "reddit_chatgpt_comments.csv",
}


def run(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    lexicon_path: str,
    settings: suite.Settings = suite.Settings(),
    partitions: int | None = None,
    modifiers_path: str | None = None,
    phrases_path: str | None = None,
    run_name: str | None = None,
) -> None:
    """With a run_name, a call that repeats one that broke off cleans again but asks only what was not answered."""
    raw = readers.read_raw(spark, {k: f"{raw_dir}/{name}" for k, name in FILES.items()}, partitions)
    modifiers = readers.read_modifiers(spark, modifiers_path) if modifiers_path else None
    phrases = readers.read_phrases(spark, phrases_path) if phrases_path else None
    suite.run_cleaning(raw, readers.read_lexicon(spark, lexicon_path), out_dir, settings, modifiers, phrases)
    report = suite.run_questions(spark, f"{out_dir}/cleaned", f"{out_dir}/tables", settings, run=run_name)
    report.coalesce(1).write.mode("overwrite").csv(f"{out_dir}/run_report", header=True)
    suite.run_figures(spark, f"{out_dir}/tables", settings)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    args.add_argument("raw_dir")
    args.add_argument("out_dir")
    args.add_argument("--lexicon", required=True, help="tab-separated token and valence")
    args.add_argument("--modifiers", help="tab-separated token and kind: 1 strengthens, -1 weakens, 0 negates")
    args.add_argument("--phrases", help="tab-separated phrase of two to four words and valence")
    args.add_argument("--run", help="name of the run: given again, questions already answered in it are not asked again")
    args.add_argument("--partitions", type=int, help="spread each header file over this many tasks")
    given = args.parse_args()
    spark = SparkSession.builder.appName("tallyhall").getOrCreate()
    run(
        spark, given.raw_dir, given.out_dir, given.lexicon, partitions=given.partitions, modifiers_path=given.modifiers,
        phrases_path=given.phrases, run_name=given.run,
    )


if __name__ == "__main__":
    main()
