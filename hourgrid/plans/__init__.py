"""Plans built from the operators: feature table, reports, backtest, stand-ins."""
