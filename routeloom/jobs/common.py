"""Shared by the jobs."""

from __future__ import annotations

from argparse import ArgumentParser


def arguments(description: str, *required: str) -> ArgumentParser:
    parser = ArgumentParser(description=description)
    for name in required:
        parser.add_argument(f"--{name}", required=True)
    return parser


def show(values: dict) -> None:
    for name, value in values.items():
        print(f"{name}={str(value).lower() if isinstance(value, bool) else value}")
