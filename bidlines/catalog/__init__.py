from . import items, runs, tables
from .registry import CHECKS, QUERIES
