"""Operators for preparing large text corpora: packing, chat formatting,
decontamination, duplicate removal at several grains, page extraction and
toxicity tagging. Nothing else in the library imports this subpackage."""
