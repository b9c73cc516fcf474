"""All queries of this subpackage, and SQL for those that SQL can express."""

from terrascape.llm import chat, queries_corpus, queries_groups, queries_text

_MODULES = (chat, queries_text, queries_groups, queries_corpus)
QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLE_SQL = {k: s for m in _MODULES for k, s in m.ORACLE_SQL.items()}
