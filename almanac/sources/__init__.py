"""Sources and sinks: daily report files, bronze dataset, staged tables, warehouse tables, JDBC."""
