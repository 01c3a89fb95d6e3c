"""Operators of a training-data pipeline: near-duplicate search, fingerprints,
language ID, licence and URL filters, packing, sharding, nearest neighbours,
source mixing and repeated-passage removal. Nothing outside this subpackage
imports it."""
