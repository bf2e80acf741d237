"""Run one stage: ``python -m strandline <stage> [arguments]`` (also as a spark-submit script)."""

from __future__ import annotations

import argparse

from strandline.plans import collisions, documents, increments, landing, unstructured
from strandline.session import build_session

STAGES = {
    "land": ("source root checkpoint", lambda s, a: landing.land_available(s, a.source, a.root, a.checkpoint, a.max_files, a.archive)),
    "trust-collisions": ("table out rejects", lambda s, a: collisions.trust_collisions(s, a.table, a.out, a.rejects)),
    "trust-new": ("table root checkpoint", lambda s, a: increments.trust_available(s, a.table, a.root, a.checkpoint)),
    "trust-weather": ("source out", lambda s, a: documents.trust_weather(s, a.source, a.out)),
    "trust-cameras": ("source out", lambda s, a: documents.trust_cameras(s, a.source, a.out)),
    "trust-texts": ("source out", lambda s, a: unstructured.trust_texts(s, a.source, a.out, a.files)),
    "trust-audio": ("source out", lambda s, a: unstructured.trust_audio(s, a.source, a.out, a.files)),
    "exploit-collisions": ("collisions weather out", lambda s, a: collisions.exploit_collisions(s, a.collisions, a.weather, a.out)),
    "exploit-texts": ("trusted out", lambda s, a: unstructured.exploit_texts(s, a.trusted, a.out, a.files)),
    "exploit-audio": ("trusted out", lambda s, a: unstructured.exploit_audio(s, a.trusted, a.out, a.files)),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandline", description=__doc__)
    stages = top.add_subparsers(dest="stage", required=True)
    for name, (arguments, _) in STAGES.items():
        stage = stages.add_parser(name)
        for argument in arguments.split():
            stage.add_argument(argument)
        if name == "land":
            stage.add_argument("--max-files", type=int, default=landing.MAX_FILES, help="files per batch")
            stage.add_argument("--archive", help="folder that landed files move to")
        if name.endswith(("texts", "audio")):
            stage.add_argument("--files", action="store_true", help="also write one file per row")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"strandline-{args.stage}")
    STAGES[args.stage][1](spark, args).show(100, truncate=False)


if __name__ == "__main__":
    main()
