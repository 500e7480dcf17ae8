"""Sources and sinks: lines, typed lines, JSON, HTML, literals, validated parsing."""
