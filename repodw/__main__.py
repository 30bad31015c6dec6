"""Command line: python -m repodw <command> … (or spark-submit this file)."""

from __future__ import annotations

import argparse

from repodw import fixed_values as V
from repodw.plans import clean, daily, profile, serve
from repodw.session import build_session, written
from repodw.sources import calendar, export
from repodw.sources.raw import raw_order, read_raw_json
from repodw.sources.store import Warehouse
from repodw.streaming.ingest import ingest_new_files


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="repodw")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *options: str):
        sub = commands.add_parser(name, help=text)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    day = command("run-day", "load one day from raw files to marts", "raw", "warehouse", "day")
    day.add_argument("--undated", action="store_true", help="also load files whose path names no day")
    landed = command("ingest", "load the days of all files that landed since the last run", "raw", "warehouse", "progress")
    landed.add_argument("--undated-day", help="the day of files whose path names none")
    many = command("backfill", "load all days that raw files belong to, or some, in one go", "raw", "warehouse")
    many.add_argument("--days", nargs="+", help="only these days")
    many.add_argument("--undated-day", help="the day of files whose path names none")
    for loads in (day, landed, many):
        loads.add_argument("--collation", help="names equal under it are one, such as UNICODE_CI_AI (a new warehouse keeps it)")
    command("rebuild", "all rollups, month sums and marts from the stored facts", "warehouse")
    dates = command("calendar", "write the day dimension", "warehouse")
    dates.add_argument("--start", default=V.CALENDAR_START)
    dates.add_argument("--end", default=V.CALENDAR_END)
    command("profile", "cleaning counts and profile of raw files", "raw")
    ask = command("query", "show a serving query", "warehouse")
    ask.add_argument("name", choices=["overview", "ranking", "language", "trend", "org-compare", "org-repos", "repos", "compare", "filter", "languages", "top-languages", "top-orgs", "audit"])
    ask.add_argument("--org")
    ask.add_argument("--names", nargs="+", help="compare: full names out of the 20 most starred, six at most")
    ask.add_argument("--measure", default="starsCount", help="compare: the measure that is shared out")
    ask.add_argument("--platform")
    ask.add_argument("--languages", nargs="+", default=[])
    ask.add_argument("--chart", default="bar", choices=["bar", "line", "pie"])
    ask.add_argument("--action")
    ask.add_argument("--keyword")
    ask.add_argument("--page", type=int, default=1)
    ask.add_argument("--size", type=int, default=10)
    csv = command("export", "write the newest detail rows as CSV", "warehouse", "out")
    csv.add_argument("--keyword")
    csv.add_argument("--single-file", action="store_true")
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session()
    if args.command == "profile":
        raw = read_raw_json(spark, args.raw)
        records = written(clean.clean_repos(raw, raw_order()).drop("pos"), "clean")
        clean.clean_audit(raw, raw_order()).show(truncate=False, vertical=True)
        for report in (profile.prof_totals, profile.prof_platform, profile.prof_org, profile.prof_star_bins,
                       profile.prof_top15, profile.prof_lang_top10, profile.prof_year, profile.prof_license):
            report(records).show(100, truncate=False)
        return
    warehouse = Warehouse(spark, args.warehouse, collation=getattr(args, "collation", None))
    if args.command == "run-day":
        daily.run_day(spark, args.raw, warehouse, args.day, undated=args.undated)
    elif args.command == "backfill":
        daily.run_days(spark, args.raw, warehouse, args.days, undated_day=args.undated_day)
    elif args.command == "ingest":
        ingest_new_files(spark, args.raw, warehouse, args.progress, undated_day=args.undated_day)
    elif args.command == "rebuild":
        daily.rebuild_rollups(warehouse)
        daily.rebuild_months(warehouse)
        daily.refresh_marts(warehouse)
    elif args.command == "calendar":
        warehouse.fill_once("dim_date", calendar.gen_dim_date(spark, args.start, args.end))
    elif args.command == "export":
        rows = export.export_rows(warehouse.latest("fact_repo_stats"), warehouse.read("dim_project"), args.keyword)
        export.write_csv(rows, args.out, args.single_file)
    else:
        _answer(warehouse, args).show(args.size if args.name == "repos" else 100, truncate=False)


def _answer(warehouse: Warehouse, args: argparse.Namespace):
    marts = {
        "overview": (serve.q_overview, "ads_overview"), "ranking": (serve.q_ranking, "ads_project_ranking"),
        "language": (serve.q_language, "ads_language_dist"), "trend": (serve.q_trend, "ads_monthly_trend"),
        "org-compare": (serve.q_org_compare, "ads_org_compare"),
    }
    if args.name in marts:
        question, table = marts[args.name]
        return question(warehouse.read(table) if args.name == "trend" else warehouse.latest(table))
    if args.name == "filter":
        return serve.filter_view(serve.q_ranking(warehouse.latest("ads_project_ranking")), args.platform, args.languages, args.chart)
    if args.name in ("languages", "top-languages"):
        rows = serve.q_language(warehouse.latest("ads_language_dist"))
        return serve.language_fold(rows) if args.name == "languages" else serve.language_table(rows)
    if args.name == "top-orgs":
        return serve.top_orgs(serve.q_org_compare(warehouse.latest("ads_org_compare")))
    if args.name == "audit":
        return serve.q_audit_log(warehouse.read("sys_log"), args.action, args.keyword, args.page, args.size)
    fact, dim = warehouse.latest("fact_repo_stats"), warehouse.read("dim_project")
    if args.name == "org-repos":
        return serve.q_org_repos(fact, dim, args.org)
    if args.name == "compare":
        return serve.q_compare(fact, dim, args.names, args.measure)
    kept = [warehouse.latest(t).drop("stat_date") for t in ("ads_repo_details", "ads_repo_ranges", "ads_repo_grams")]
    return serve.kept_search_page(*kept, args.keyword, args.page, args.size)


if __name__ == "__main__":
    main()
