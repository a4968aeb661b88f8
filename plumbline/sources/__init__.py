"""Reading and writing: dataset catalogue, sinks, fitted state, trial log."""
