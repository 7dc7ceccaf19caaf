from siltstone.cli import main

raise SystemExit(main())
