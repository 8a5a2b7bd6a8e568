"""Table operators: rows, joins, aggregates, scaling, learning, forecasting, backtesting."""
