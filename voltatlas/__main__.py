"""Jobs for spark-submit: ``python -m voltatlas --lake <folder> <job> ...``."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from voltatlas.operators import access
from voltatlas.plans.refresh import MODELS, publish_status, refresh_all
from voltatlas.session import build_session
from voltatlas.sources import landing
from voltatlas.sources.lake import Lake, read_emissions, read_weather
from voltatlas.streaming import fleet, incremental


def arguments(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="voltatlas", description=__doc__)
    parser.add_argument("--lake", required=True, help="folder of the table layers")
    jobs = parser.add_subparsers(dest="job", required=True)
    jobs.add_parser("create", help="create the raw tables that are missing")
    load = jobs.add_parser("load", help="fetch whole datasets; run it again to fetch what failed")
    load.add_argument("tables", nargs="*", default=list(landing.LOADS))
    load.add_argument("--base", help="address of the service, or folder of page files that every executor sees")
    load.add_argument("--parallel", type=int, default=8)
    load.add_argument("--load-id", default="all", help="rows of an earlier load of this name are replaced")
    load.add_argument("--sample", type=int, metavar="PAGES", help="fetch only so many pages and mark the tables as a sample")
    refresh = jobs.add_parser("refresh", help="rebuild every model")
    refresh.add_argument("--weather", help="folder of the hourly weather table")
    refresh.add_argument("--emissions", help="folder of the emissions table")
    refresh.add_argument("--skip-missing", action="store_true", help="leave out models whose inputs are missing")
    refresh.add_argument("--allow-incomplete", action="store_true", help="also from samples and loads with lost pages")
    update = jobs.add_parser("update", help="bring the incremental models up to date and publish them")
    update.add_argument("--state", required=True)
    update.add_argument("--checkpoint", required=True)
    watch = jobs.add_parser("watch", help="keep the fleet status up to date")
    watch.add_argument("--state", required=True)
    watch.add_argument("--checkpoint", required=True)
    publish = jobs.add_parser("publish", help="replace what dealers and manufacturers may read")
    publish.add_argument("--share", required=True)
    return parser.parse_args(words)


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def load(lake: Lake, args: argparse.Namespace) -> int:
    """Returns the number of tables that are not complete."""
    options = {"retries": 3, "parallel": args.parallel, **({"base": args.base} if args.base else {})}
    if args.sample:
        options["pages"] = args.sample
    for table in args.tables:
        failed = landing.load(lake, table, args.load_id, **options)
        for row in failed.limit(20).collect():
            print(table, f"part {row.part}, from row {row.page_offset}: {row.error}")
        print(table, "failed pages:", failed.count())
    return sum(bool(lake.incomplete(table)) for table in args.tables) if not args.sample else 0


def update(lake: Lake, state: str, checkpoint: str) -> list[str]:
    """Brings what has changed in the raw tables, new and corrected loads, into the incremental models and publishes each."""
    done = []
    for name, (layer, source) in incremental.SUM_TABLES.items():
        model = incremental.SUM_MODELS[name]
        above = {key: counted for key, counted in incremental.COUNTED_MODELS.items() if counted.source == name}
        incremental.refresh_sums(lake.stream(source), model, f"{state}/{name}", f"{checkpoint}/{name}",
                                 counted_models=above).awaitTermination()
        lake.replace(incremental.read_sums(lake.spark, model, f"{state}/{name}"), layer, name)
        for key, counted in above.items():
            lake.replace(incremental.read_counted(lake.spark, f"{state}/{name}", key, counted), "analytics", key)
        done += [name, *above]
    for name, (layer, left, right) in incremental.JOIN_TABLES.items():
        model = incremental.JOIN_MODELS[name]
        incremental.refresh_join(lake.stream(left, raw_json=True), lake.stream(right), model, f"{state}/{name}",
                                 f"{checkpoint}/{name}").awaitTermination()
        lake.replace(incremental.read_join(lake.spark, model, f"{state}/{name}"), layer, name)
        done.append(name)
    return done


def watch(lake: Lake, state: str, checkpoint: str, trigger: dict[str, object]):
    """Starts the fleet stream; after each batch the status and the alerts are replaced and their refresh is logged."""
    telemetry = lake.read("raw", "telemetry_raw").drop("raw_json")
    events = lake.spark.readStream.schema(telemetry.schema).parquet(lake.path("raw", "telemetry_raw"))

    def publish(spark, batch_id: int) -> None:
        raw = lake.read("raw", "telemetry_raw")
        publish_status(lake, fleet.current_status(spark, state, now(), raw))

    return fleet.refresh_status(events, state, checkpoint, trigger=trigger, keep_hours=fleet.KEEP_HOURS,
                                after_batch=publish)


def publish(lake: Lake, share: str) -> list[str]:
    models = {m.name: lake.read(m.layer, m.name) for m in MODELS if m.name in access.DEALER_MODELS}
    names = access.publish(models, f"{share}/dealers")
    access.publish_by_group(access.dealer_extract(models["ev_infrastructure_correlation"]), f"{share}/groups")
    access.publish_totals(models["ev_growth_trends"], share)
    return [*names, *access.DEALER_GROUPS.values(), "manufacturer_totals"]


def main(words: list[str] | None = None) -> int:
    args = arguments(words)
    spark = build_session(f"voltatlas {args.job}")
    lake = Lake(spark, args.lake)
    if args.job == "create":
        print("created", *lake.create_missing())
    elif args.job == "load":
        return 1 if load(lake, args) else 0
    elif args.job == "refresh":
        external = {}
        if args.weather:
            external["weather_hourly"] = read_weather(spark, args.weather)
        if args.emissions:
            external["emissions"] = read_emissions(spark, args.emissions)
        print("refreshed", *refresh_all(lake, external, args.skip_missing, args.allow_incomplete, as_of=now()))
    elif args.job == "update":
        print("updated", *update(lake, args.state, args.checkpoint))
    elif args.job == "watch":
        watch(lake, args.state, args.checkpoint, {"processingTime": "1 minute"}).awaitTermination()
    else:
        print("published", *publish(lake, args.share))
    return 0


if __name__ == "__main__":
    sys.exit(main())
