"""Job entry points for spark-submit: ``python -m delaycast <job> ...``.

    positions-batch --src DIR --out DIR          hourly positions -> keyed table
    weather-batch   --src DIR --out DIR          daily observations -> keyed table
    train           --positions DIR --weather DIR --model DIR
    stream          --bus-topic T --obs-topic T --fc-topic T --bootstrap HOST:PORT
                    --model DIR --out DIR --checkpoint DIR

The session comes from spark-submit (master, resources); only the runtime
settings the operators rely on are applied. Streams use the broker by
default (``--format`` switches to a file source for dry runs).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from . import session as S


def _spark() -> SparkSession:
    return S.configure(SparkSession.builder.appName("delaycast").getOrCreate())


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="delaycast")
    sub = ap.add_subparsers(dest="job", required=True)
    pb = sub.add_parser("positions-batch")
    pb.add_argument("--src", required=True)
    pb.add_argument("--out", required=True)
    pb.add_argument("--anchor", help="ISO time (default: now, UTC)")
    wb = sub.add_parser("weather-batch")
    wb.add_argument("--src", required=True)
    wb.add_argument("--out", required=True)
    wb.add_argument("--anchor")
    tr = sub.add_parser("train")
    tr.add_argument("--positions", required=True)
    tr.add_argument("--weather", required=True)
    tr.add_argument("--model", required=True)
    tr.add_argument("--date")
    st = sub.add_parser("stream")
    for a in ("--bus-topic", "--obs-topic", "--fc-topic", "--model", "--out", "--checkpoint"):
        st.add_argument(a, required=True)
    st.add_argument("--bootstrap", default=None)
    st.add_argument("--format", default="kafka")
    st.add_argument("--max-offsets", type=int, default=None)
    st.add_argument("--trigger", default="30 seconds")
    st.add_argument("--table", default=None, help="keyed table by date that the batch folders of --out are folded into")
    args = ap.parse_args(argv)

    spark = _spark()
    anchor = dt.datetime.fromisoformat(args.anchor) if getattr(args, "anchor", None) else None
    if args.job == "positions-batch":
        from .plans.batch_jobs import load_positions_hour
        load_positions_hour(spark, args.src, args.out, anchor)
    elif args.job == "weather-batch":
        from .plans.batch_jobs import load_weather_day
        load_weather_day(spark, args.src, args.out, anchor)
    elif args.job == "train":
        from .plans.training import train_from_files
        print(f"r2={train_from_files(spark, args.positions, args.weather, args.model, args.date)}")
    elif args.job == "stream":
        from .sources import readers as R
        from .sources.sinks import load_model
        from .streaming.jobs import production_stream, reject_stream

        def src(topic):
            if args.format == "kafka":
                opts = R.kafka_options(args.bootstrap, topic, "latest", args.max_offsets)
                return R.message_text(R.read_stream(spark, "kafka", opts))
            return R.read_stream(spark, args.format, {"maxFilesPerTrigger": "1"}, path=topic)

        feeds = [src(args.bus_topic), src(args.obs_topic), src(args.fc_topic)]
        every = {"processingTime": args.trigger}
        production_stream(*feeds, load_model(args.model), args.out, args.checkpoint, trigger=every, fold_into=args.table)
        reject_stream(*feeds, f"{args.out.rstrip('/')}_rejects", f"{args.checkpoint.rstrip('/')}_rejects", trigger=every)
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
