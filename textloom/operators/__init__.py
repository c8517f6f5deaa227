"""DataFrame operators: quotas, statistics, ledger, vocabulary, encoding."""
