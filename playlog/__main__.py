"""The library's jobs by name: ``python -m playlog import|run|rebuild|export ...``, or the same under spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from . import model
from .plans import pipeline
from .session import session
from .sources import export, files, paged

#: Settings of a service's client, from the environment.
CLIENT = {"SERVICE_CLIENT_ID": "client_id", "SERVICE_CLIENT_SECRET": "client_secret", "SERVICE_REFRESH_TOKEN": "refresh_token", "SERVICE_TOKEN_URL": "token_url"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="playlog", description=__doc__)
    top.add_argument("--database", help="made if it isn't there, and used")
    jobs = top.add_subparsers(dest="job", required=True)
    one = jobs.add_parser("import", help="load an exported history")
    one.add_argument("folder")
    one.add_argument("--service", required=True, help="how the uri field's name begins")
    one.add_argument("--lines", action="store_true", help="files hold an object a line")
    one.add_argument("--keep-going", action="store_true", help="put unreadable files aside instead of stopping")
    one = jobs.add_parser("run", help="load the library and recent plays, rebuild, export")
    one.add_argument("--liked", required=True, help="the service's url, or a folder of pages")
    one.add_argument("--recent", required=True)
    one.add_argument("--export")
    one = jobs.add_parser("rebuild", help="derive the analytics anew")
    one.add_argument("only", nargs="*")
    one = jobs.add_parser("export", help="tables as CSV files")
    one.add_argument("folder")
    return top


def source(place: str) -> dict[str, str]:
    """Options of a paged source: a url with the client's settings, or a folder."""
    if place.startswith(("http://", "https://")):
        return {"url": place} | {CLIENT[k]: v for k, v in files.settings(list(CLIENT)).items()}
    return {"path": place}


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    given = parser().parse_args(args)
    spark = spark or session()
    if given.database:
        from .operators.merge import ensure_database

        ensure_database(spark, given.database)
    if given.job == "import":
        print(pipeline.import_history(spark, given.folder, given.service, given.lines, not given.keep_going))
    elif given.job == "run":
        liked, recent = source(given.liked), source(given.recent) | {"single": "true"}
        print(pipeline.run(spark, lambda mark: paged.read_items(spark, model.RAW_LIKED, mark, **liked), lambda: paged.read_items(spark, model.RAW_RECENT, **recent), given.export))
    elif given.job == "rebuild":
        print(pipeline.rebuild(spark, only=given.only or None))
    else:
        print(export.export_tables(spark, pipeline.EXPORTS, given.folder))


if __name__ == "__main__":
    main()
