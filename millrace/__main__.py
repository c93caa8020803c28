"""python -m millrace list | run NAME DIR [--out PATH] [--show N] [--explain] | apply OPERATOR INPUT [OUTPUT] [NAME=VALUE ...] [--with PATH ...]"""

from __future__ import annotations

import argparse
import importlib
import inspect
import json
import pkgutil
import sys
from typing import Any


def operators() -> dict[str, Any]:
    """Every function of the operator modules whose first parameter is a DataFrame and which gives one, as module.function."""
    from . import operators as package

    found = {}
    for info in pkgutil.iter_modules(package.__path__):
        module = importlib.import_module(f"{package.__name__}.{info.name}")
        for name, f in inspect.getmembers(module, inspect.isfunction):
            parameters = inspect.signature(f).parameters.values()
            kinds = [p.annotation for p in parameters]
            if any(p.annotation is inspect.Parameter.empty and p.default is inspect.Parameter.empty for p in parameters):
                continue  # takes a function
            if f.__module__ == module.__name__ and not name.startswith("_") and kinds[:1] == ["DataFrame"] and inspect.signature(f).return_annotation == "DataFrame":
                found[f"{info.name}.{name}"] = f
    return found


def value_of(text: str, kind: str) -> Any:
    """A flag's value by its parameter's type: a SQL expression for a column, text as it is, anything else as JSON."""
    if "Column" in kind and "str" not in kind:
        from pyspark.sql import functions as F

        return F.expr(text)
    if kind in ("str", "str | None", "str | Column"):
        return text
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        return text


def apply(name: str, frames: list, flags: list[str]):
    """Calls an operator with its DataFrames in order and its flags by name."""
    known = operators()
    if name not in known:
        raise SystemExit(f"no operator {name}; see list --operators")
    parameters = inspect.signature(known[name]).parameters
    rest = {}
    for flag in flags:
        key, sign, text = flag.partition("=")
        if not sign or key not in parameters and "entry" not in parameters:
            raise SystemExit(f"{flag}: the flags of {name} are {', '.join(f'{k}=...' for k, p in parameters.items() if p.annotation != 'DataFrame')}")
        rest[key] = value_of(text, str(parameters[key].annotation) if key in parameters else "str")
    wanted = [k for k, p in parameters.items() if p.annotation == "DataFrame"]
    if len(frames) != len(wanted):
        raise SystemExit(f"{name} takes {len(wanted)} inputs: {', '.join(wanted)}")
    missing = [k for k, p in parameters.items() if p.default is inspect.Parameter.empty and p.kind is not p.VAR_KEYWORD and k not in rest and k not in wanted]
    if missing:
        raise SystemExit(f"{name} needs {', '.join(f'{k}=...' for k in missing)}")
    return known[name](**dict(zip(wanted, frames, strict=True)), **rest)


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="millrace", description="Registered queries over a directory of tables, and single operators over files.")
    commands = parser.add_subparsers(dest="command", required=True)
    listed = commands.add_parser("list", help="names and descriptions")
    listed.add_argument("--operators", action="store_true", help="those that apply takes, instead of queries")
    run = commands.add_parser("run", help="run one query")
    run.add_argument("name")
    run.add_argument("directory")
    run.add_argument("--out", help="write the result as Parquet here")
    one = commands.add_parser("apply", help="one operator from input to output")
    one.add_argument("operator")
    one.add_argument("input")
    one.add_argument("rest", nargs="*", metavar="OUTPUT | NAME=VALUE", help="where to write Parquet, and flags")
    one.add_argument("--with", dest="others", action="append", default=[], metavar="PATH", help="further inputs, in order")
    for c in (run, one):
        c.add_argument("--show", type=int, default=20, help="rows to print if nothing is written")
        c.add_argument("--explain", action="store_true", help="print the plan instead of running it")
    given = parser.parse_args(arguments)

    from .plans.queries import QUERIES
    from .sources.readers import catalog, load

    if given.command == "list":
        for name, text in catalog(operators() if given.operators else QUERIES):
            print(f"{name:36} {text}")
        return 0
    if given.command == "run" and given.name not in QUERIES:
        print(f"no query {given.name}; see list", file=sys.stderr)
        return 2
    from .plans.explain import plan
    from .session import session, ship
    from .sources.sinks import replace

    spark = session()
    ship(spark)
    if given.command == "run":
        df, out = QUERIES[given.name](spark, given.directory), given.out
    else:
        outputs = [x for x in given.rest if "=" not in x]
        if len(outputs) > 1:
            parser.error(f"one output, not {', '.join(outputs)}")
        df = apply(given.operator, [load(spark, p) for p in (given.input, *given.others)], [x for x in given.rest if "=" in x])
        out = outputs[0] if outputs else None
    if given.explain:
        print(plan(df))
    elif out:
        print(replace(df, out))
    else:
        df.show(given.show, truncate=60)
    return 0


if __name__ == "__main__":
    sys.exit(main())
