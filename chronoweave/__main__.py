"""``python -m chronoweave spec.yaml raw/ out/ [name=value ...]``: a whole run; values are YAML, names those of ``Options`` or ``stages``."""

from __future__ import annotations

import sys

import yaml

from .plans import pipeline


def main(args: list[str] | None = None) -> None:
    args = sys.argv[1:] if args is None else args
    if len(args) < 3 or any("=" not in a for a in args[3:]):
        raise SystemExit(__doc__)
    given = {k: yaml.safe_load(v) for k, _, v in (a.partition("=") for a in args[3:])}
    stages = given.pop("stages", None)
    for what, path in pipeline.run(pipeline.session(), *args[:3], pipeline.Options(**given), stages).items():
        print(f"{what}: {path}")


if __name__ == "__main__":
    main()
