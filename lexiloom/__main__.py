"""python -m lexiloom: the steps of corpus preparation as commands."""

from __future__ import annotations

import argparse

from lexiloom.plans import prepare
from lexiloom.session import session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lexiloom", description=__doc__)
    top.add_argument("--master", default=None, help="Spark master; default: the session's own, or local[*]")
    sub = top.add_subparsers(dest="command", required=True)
    for kind in ("pdf", "epub", "crawl", "txt"):
        one = sub.add_parser(f"{kind}2txt", help=f"{kind} files to text shards")
        one.add_argument("source")
        one.add_argument("target")
        one.add_argument("--limit-mb", type=int, default=256)
        if kind == "crawl":
            one.add_argument("--lang", required=True)
        if kind in ("pdf", "epub"):
            one.add_argument("--errors", choices=("raise", "null"), default="raise")
    build = sub.add_parser("build-tokenizer", help="learn a vocabulary from text files")
    build.add_argument("--vocab-size", type=int, default=65_535)
    build.add_argument("--min-frequency", type=int, required=True)
    build.add_argument("--lowercase", action="store_true", help="accepted for its callers; texts are case-folded in any case")
    tokens = sub.add_parser("tokenize", help="text files to token shards")
    tokens.add_argument("--tokenizer-path", default=None)
    tokens.add_argument("--dtype", choices=("u16", "u32"), default="u16")
    tokens.add_argument("--separator", type=int, default=None)
    tokens.add_argument("--limit-mb", type=int, default=256)
    for one in (build, tokens):
        one.add_argument("--input-dir", required=True)
        one.add_argument("--output-dir", required=True)
        one.add_argument("--turkish", action="store_true", help="map I and İ to ı and i before case folding")
        one.add_argument("--max-workers", type=int, default=None, help="tasks at a time on a local master")
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    workers = getattr(a, "max_workers", None)
    spark = session(a.master or f"local[{workers or '*'}]")
    if a.command == "build-tokenizer":
        prepare.build_tokenizer(spark, a.input_dir, a.output_dir, a.vocab_size, a.min_frequency, a.turkish)
    elif a.command == "tokenize":
        prepare.tokenize(spark, a.input_dir, a.output_dir, a.tokenizer_path, a.dtype, a.limit_mb, a.separator, a.turkish)
    else:
        prepare.to_text(spark, a.command.removesuffix("2txt"), a.source, a.target, getattr(a, "lang", None), a.limit_mb, getattr(a, "errors", "raise"))


if __name__ == "__main__":
    main()
