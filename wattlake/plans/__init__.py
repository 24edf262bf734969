"""Jobs composed of operators: training, forecast, the registered queries."""
