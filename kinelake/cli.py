"""Command line: run, verify, register-local, import-unitree (XR captures), export-lerobot (columnar episodes)."""

from __future__ import annotations

import argparse
import json

from kinelake.session import build_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kinelake", description="Auditable robot-trajectory data on Spark; controls no robot.")
    p.add_argument("--master", help="Spark master, e.g. local[8]")
    sub = p.add_subparsers(dest="verb", required=True)

    def verb(name: str, help_: str, *required: str) -> argparse.ArgumentParser:
        s = sub.add_parser(name, help=help_)
        for r in required:
            s.add_argument(f"--{r}", required=True)
        return s

    s = verb("run", "build the release of a source lock", "lock", "root")
    s.add_argument("--recipe", help="JSON file with changes to the recipe")
    s.add_argument("--offline", action="store_true")
    sub.add_parser("verify", help="check every file of a release").add_argument("release")
    verb("register-local", "copy a described batch and write its lock", "source-dir", "descriptor", "root", "output")
    verb("import-unitree", "prepare a batch from XR captures", "source-dir", "mapping", "output")
    s = verb("export-lerobot", "write one source and split in the columnar layout", "release", "raw-root", "source", "output")
    s.add_argument("--split", required=True, choices=["train", "validation"])
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.verb == "verify":
        from kinelake.release import verify_release

        out: object = {"release_id": (m := verify_release(a.release))["release_id"], "files": len(m["output_sha256"])}
    elif a.verb == "register-local":
        from kinelake.register import register_local

        out = {"registered": register_local(a.source_dir, a.descriptor, a.root, a.output)["sources"][0]["id"], "lock": a.output}
    else:
        spark = build_session(master=a.master)
        if a.verb == "run":
            from kinelake.release import run
            from kinelake.sources.files import read_json

            manifest, reused = run(spark, a.lock, a.root, a.offline, read_json(a.recipe) if a.recipe else None)
            out = {k: v for k, v in manifest.items() if k not in ("output_sha256", "recipe")} | {"reused": reused}
        elif a.verb == "import-unitree":
            from kinelake.importer import import_captures

            out = {"episodes": len(import_captures(spark, a.source_dir, a.mapping, a.output)["episodes"]), "deployment_ready": False}
        else:
            from kinelake.export import export

            out = export(spark, a.release, a.raw_root, a.source, a.split, a.output)
    print(json.dumps(out, ensure_ascii=False, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
