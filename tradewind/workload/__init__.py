"""The jobs on the benchmark tables: queries, their SQL oracle, and staged CSV folders."""
