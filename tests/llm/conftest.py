import os
from pathlib import Path

# Python workers import the package by name, whatever the folder pytest was started from.
ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])
