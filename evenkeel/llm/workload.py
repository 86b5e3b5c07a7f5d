"""The registered queries of the subpackage and the SQL that checks them."""

from evenkeel.llm import chat, decontamination, jaccard, packing, recipes, repair, repeats, resampling, sanitise, simhash, token_files, toxicity, url_filter

_MODULES = (url_filter, repeats, recipes, chat, decontamination, packing, jaccard, toxicity, token_files, sanitise, simhash, resampling, repair)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
