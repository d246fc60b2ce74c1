"""Command line, for ``spark-submit`` or ``python -m linkloom``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from linkloom.operators.links import MIN_LINKS
from linkloom.plans import files
from linkloom.runtime import clear_workspace


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="linkloom")
    jobs = root.add_subparsers(required=True)

    def job(name: str, run, *required: str, **optional) -> None:
        command = jobs.add_parser(name, help=(run.__doc__ or "").splitlines()[0])
        command.set_defaults(run=run)
        for option in required:
            command.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            name = f"--{option.replace('_', '-')}"
            if default is False:
                command.add_argument(name, action="store_true")
            else:
                command.add_argument(name, type=str if default is None else type(default), default=default)

    job(
        "rank", files.rank_files, "input-path", "output-path", project="en", limit=-1, shards=0, shard_id=-1,
        skip_corrupt=False, on_error="fail",
    )
    job("merge", files.merge_files, "input-path", "output-path", limit=-1)
    job("clean", files.clean_file, "input-path", "output-path")
    job(
        "filter", files.filter_file, "input-path", "output-path", page_filter=None, index_filter=None,
        index_output=None, chunk_size=0, skip=0, on_error="fail",
    )
    job("filter-all", files.filter_files, "input-path", "output-path", "base", "page-filter", chunk_size=1000, on_error="fail")
    job("load", files.load_dump, "path", "table", "output-path")
    job("count", files.count_files, "tables", "page-dictionary", "category-file", min_links=MIN_LINKS)
    job(
        "matrix", files.matrix_files, "tables", "page-dictionary", "category-file", "output-path", shards=32, shard_id=-1,
        binary=False,
    )
    job(
        "zeros", files.zero_files, "input-path", "page-dictionary", "category-file", "output-path", shards=64, factor=1.0,
        binary=False,
    )
    job("train", files.train_files, "matrix-path", "page-dictionary", "output-path", k=100, epochs=100, fresh=False)
    return root


def main(arguments: list[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    run = options.pop("run")
    run(SparkSession.builder.appName("linkloom").getOrCreate(), **options)


if __name__ == "__main__":
    try:
        main()
    finally:
        # There is none after --help or an error in the arguments.
        session = SparkSession.getActiveSession()
        if session is not None:
            clear_workspace(session)
