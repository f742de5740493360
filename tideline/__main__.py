"""The commands of a replica: ``python -m tideline COMMAND --config FILE --root FOLDER [--source NAME] ...``"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tideline.plans.engine import Replica
from tideline.sources.config import Config
from tideline.streaming.replication import run_replica, stop_all_replicas

COMMANDS = ("create_replica_schema", "drop_replica_schema", "add_source", "drop_source", "init_replica", "refresh_schema", "sync_tables", "copy_schema", "start_replica", "stop_replica", "stop_all_replicas", "enable_replica", "detach_replica", "update_schema_mappings", "run_maintenance", "show_config", "show_sources", "show_status", "show_errors")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tideline", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--config", required=True)
    parser.add_argument("--root", required=True, help="folder of the replicated tables")
    parser.add_argument("--source")
    parser.add_argument("--tables", help="schema.table,... or disabled")
    parser.add_argument("--origin", help='JSON file: {"schema.table": {"location": path or JDBC options, "key": [columns]}, ...}')
    parser.add_argument("--at", default="0:0", help="coordinate of the copy, file number:position")
    parser.add_argument("--log", help="folder of the change log")
    parser.add_argument("--schema", help="origin schema of copy_schema")
    parser.add_argument("--ddl", help="file of CREATE TABLE statements for copy_schema")
    parser.add_argument("--once", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tideline").getOrCreate()
    replica = Replica(spark, Config.load(args.config), args.root)
    if args.command == "create_replica_schema":
        replica.create_schema()
    elif args.command == "drop_replica_schema":
        replica.drop_schema()
    elif args.command in ("init_replica", "refresh_schema", "sync_tables"):
        with open(args.origin) as f:
            origin = json.load(f)
        seq, pos = map(int, args.at.split(":"))
        places, keys = {k: v["location"] for k, v in origin.items()}, {k: v.get("key", []) for k, v in origin.items()}
        print(replica.sync_tables(args.source, args.tables, places, keys, (seq, pos)) if args.command == "sync_tables" else replica.init_replica(args.source, places, keys, (seq, pos)))
    elif args.command == "copy_schema":
        with open(args.ddl) as f:
            print(replica.copy_schema(args.source, f.read(), args.schema))
    elif args.command == "start_replica":
        print(run_replica(replica, args.source, args.log, f"{args.root}/_checkpoint/{args.source}", rounds=1 if args.once else None))
    elif args.command == "stop_all_replicas":
        stop_all_replicas(replica)
    elif args.command == "stop_replica":
        replica.stop(args.source)
    elif args.command == "show_config":
        print(replica.show_config())
    elif args.command.startswith("show_"):
        getattr(replica, args.command)().show(truncate=False)
    else:
        print(getattr(replica, args.command)(args.source) or "")


if __name__ == "__main__":
    main()
